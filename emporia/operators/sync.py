"""Table sync and row-change operators.

Keys A8-A18 and E8. A change feed is a frame with the row's columns plus
``_change_type`` ('insert', 'update_postimage', 'delete'; 'update_preimage'
rows are ignored), ``_commit_version``, ``_commit_ts`` and ``_seq`` (order
of changes inside one version).

The latest change per key is row 1 of a window ordered by (version, seq).
Spark plans such a filter as a group limit below the shuffle: each map
partition passes on one row per key, so a key with a third of all changes
costs one row per partition after it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGE_FIELDS = [T.StructField("_change_type", T.StringType()), T.StructField("_commit_version", T.LongType()),
                 T.StructField("_commit_ts", T.TimestampNTZType()), T.StructField("_seq", T.IntegerType())]
CHANGE_COLS = [f.name for f in CHANGE_FIELDS]


def _data_cols(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in CHANGE_COLS]


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column] | list[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (default: all columns, ascending)."""
    w = Window.partitionBy(*keys).orderBy(*(order or [F.col(c) for c in rows.columns]))
    return rows.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") == 1).drop("_nth")


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str],
                     order: list[str] | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO NOTHING.

    The first row per key in ``rows`` wins; keys already in ``target`` keep
    the target row. Returns the new full table.
    """
    new = rows.select(*target.columns).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(first_per_key(new, keys, order).select(*target.columns))


def insert_select(target: DataFrame, query: DataFrame) -> DataFrame:
    """INSERT INTO target SELECT ... (columns matched by name)."""
    return target.unionByName(query.select(*target.columns))


def latest_changes(changes: DataFrame, keys: list[str], since_version: int | None = None,
                   until_version: int | None = None, until_ts=None, with_seq: bool = False) -> DataFrame:
    """Newest change per key in (since_version, until_version] / up to until_ts.

    Returns the data columns plus ``_change_type`` and ``_commit_version``
    (and ``_seq`` with ``with_seq``). Input order does not matter: late or
    repeated change rows resolve to the same result.
    """
    c = changes.filter(F.col("_change_type") != "update_preimage")
    if since_version is not None:
        c = c.filter(F.col("_commit_version") > since_version)
    if until_version is not None:
        c = c.filter(F.col("_commit_version") <= until_version)
    if until_ts is not None:
        c = c.filter(F.col("_commit_ts") <= F.lit(until_ts).cast("timestamp_ntz"))
    newest = first_per_key(c, keys, [F.col("_commit_version").desc(), F.col("_seq").desc()])
    data = _data_cols(c)
    return newest.select(*keys, *[x for x in data if x not in keys], "_change_type", "_commit_version",
                         *(["_seq"] if with_seq else []))


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the newest change per key into ``target``: deletes remove the
    key, inserts/updates replace the row. Applying it twice equals once.

    ``keys`` are the target's primary key. The feed is read once: its newest
    rows are joined to the target in one full outer join (both sides have
    unique keys, so no key is hot).
    """
    cols = target.columns
    latest = latest_changes(changes, keys).select(
        *keys, F.struct(*[c for c in cols if c not in keys], F.lit(1).alias("_hit")).alias("_new"), "_change_type")
    old = target.select(*keys, F.struct(*[c for c in cols if c not in keys], F.lit(1).alias("_hit")).alias("_old"))
    j = old.join(latest, keys, "full_outer").filter(
        F.col("_change_type").isNull() | (F.col("_change_type") != "delete"))
    row = F.when(F.col("_change_type").isNull(), F.col("_old")).otherwise(F.col("_new"))
    return (j.select(*keys, row.alias("_row"))
            .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in cols]))


def sync_triggered(target: DataFrame, changes: DataFrame, keys: list[str], since_version: int,
                   until_version: int | None = None) -> DataFrame:
    """Apply the changes with version in (since, until] to a target that was
    synced up to ``since_version``. Returns the new target state."""
    c = changes.filter(F.col("_commit_version") > since_version)
    if until_version is not None:
        c = c.filter(F.col("_commit_version") <= until_version)
    return upsert(target, c, keys)


def changed_ratio(changes: DataFrame, target_rows: DataFrame | int, keys: list[str],
                  since_version: int) -> DataFrame:
    """Distinct changed keys since a version over the target's row count (one row)."""
    n_changed = (changes.filter(F.col("_commit_version") > since_version)
                 .select(*keys).distinct().agg(F.count(F.lit(1)).alias("changed_rows")))
    if isinstance(target_rows, int):
        total = F.lit(target_rows).cast("long")
    else:
        total = target_rows.select(F.count(F.lit(1))).scalar()
    base = n_changed.withColumn("target_rows", total)
    return base.withColumn("changed_fraction",
                           F.when(F.col("target_rows") > 0, F.col("changed_rows") / F.col("target_rows")))


def changed_ratio_of_feed(changes: DataFrame, keys: list[str], since_version: int) -> DataFrame:
    """``changed_ratio`` where the target is what the feed itself gave up to ``since_version``.

    Neither state is built: one aggregate over (key, version, seq, kind) says for
    each key whether it was alive at that version and whether it changed since,
    one row of counts follows. Both are partial, so a key with a third of the
    feed costs a row a task.
    """
    at = F.struct("_commit_version", "_seq", (F.col("_change_type") != "delete").alias("alive"))
    old = F.col("_commit_version") <= since_version
    per_key = (changes.filter(F.col("_change_type") != "update_preimage").groupBy(*keys)
               .agg(F.max(F.when(old, at)).alias("last"), F.max(~old).alias("changed")))
    n = per_key.agg(F.count(F.when(F.col("changed"), 1)).alias("changed_rows"),
                    F.count(F.when(F.col("last.alive"), 1)).alias("target_rows"))
    return n.withColumn("changed_fraction", F.when(F.col("target_rows") > 0, F.col("changed_rows") / F.col("target_rows")))


def choose_sync_mode(ratio: DataFrame, needs_seconds: bool = False, threshold: float = 0.10) -> DataFrame:
    """A11: 'continuous' if seconds of latency are needed; else 'snapshot' when
    more than ``threshold`` of the rows changed or the target is empty; else 'triggered'."""
    full = F.col("changed_fraction").isNull() | (F.col("changed_fraction") > threshold)
    mode = (F.lit("continuous") if needs_seconds else
            F.when(full, F.lit("snapshot")).otherwise(F.lit("triggered")))
    return ratio.withColumn("mode", mode)


# --- type mapping for a serving copy (A14-A16) --------------------------------

# Spark type -> serving (PostgreSQL) type, as documented.
SYNC_TYPE_MAP = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "SMALLINT",
    "string": "TEXT", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP WITHOUT TIME ZONE",
    "decimal": "NUMERIC", "binary": "BYTEA", "array": "JSONB", "map": "JSONB", "struct": "JSONB",
    "float": "REAL", "double": "DOUBLE PRECISION",
}
# The documented table lists TIMESTAMP -> without zone and TIMESTAMP_NTZ -> with zone.
REFERENCE_TYPE_MAP = dict(SYNC_TYPE_MAP, timestamp="TIMESTAMP WITHOUT TIME ZONE",
                          timestamp_ntz="TIMESTAMP WITH TIME ZONE")
UNSUPPORTED_TYPES = ("geography", "geometry", "variant", "object")


class UnsupportedTypeError(ValueError):
    pass


def _type_key(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return "decimal"
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return dt.typeName()
    return dt.simpleString().split("(")[0]


def strip_null_bytes_col(c: Column, dt: T.DataType) -> Column:
    """Remove U+0000 from strings, recursing into arrays, maps and structs."""
    if isinstance(dt, T.StringType):
        return F.regexp_replace(c, "\u0000", "")
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: strip_null_bytes_col(x, dt.elementType))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda k, v: strip_null_bytes_col(v, dt.valueType))
    if isinstance(dt, T.StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[strip_null_bytes_col(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    return c


def strip_null_bytes(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Remove 0x00 from string columns (and nested strings)."""
    cols = cols or df.columns
    return df.select(*[strip_null_bytes_col(F.col(f.name), f.dataType).alias(f.name) if f.name in cols
                       else F.col(f.name) for f in df.schema.fields])


def string_to_binary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep the exact bytes by casting strings to binary."""
    return df.select(*[F.col(c).cast("binary").alias(c) if c in cols else F.col(c) for c in df.columns])


def map_types_for_sync(df: DataFrame, mapping: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Frame converted to the serving type set plus a (column, spark_type,
    target_type) report. Arrays/maps/structs become JSON text (strings inside
    cleaned of 0x00 first); unsupported types raise, listing every column."""
    mapping = mapping or SYNC_TYPE_MAP
    bad = [f.name for f in df.schema.fields if _type_key(f.dataType) in UNSUPPORTED_TYPES
           or _type_key(f.dataType) not in mapping]
    if bad:
        raise UnsupportedTypeError(f"unsupported column types for sync: {', '.join(bad)}")
    out, report = [], []
    for f in df.schema.fields:
        k = _type_key(f.dataType)
        target = mapping[k]
        if k in ("array", "map", "struct"):
            out.append(F.to_json(strip_null_bytes_col(F.col(f.name), f.dataType)).alias(f.name))
        elif k == "string":
            out.append(strip_null_bytes_col(F.col(f.name), f.dataType).alias(f.name))
        else:
            out.append(F.col(f.name))
        report.append((f.name, f.dataType.simpleString(), target))
    spark = df.sparkSession
    rep = spark.createDataFrame(report, "column string, spark_type string, target_type string")
    return df.select(*out), rep


def sync_verify(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Per-side row counts, keys missing on either side, and keys whose
    values differ (one row).

    Joined on the primary key (unique on both sides), so the full outer join
    has no hot key.
    """
    cols = [c for c in source.columns if c in target.columns and c not in keys]
    s = source.select(*keys, F.struct(*cols, F.lit(1).alias("_hit")).alias("_s"))
    t = target.select(*keys, F.struct(*cols, F.lit(1).alias("_hit")).alias("_t"))
    j = s.join(t, keys, "full_outer")
    both = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    return j.agg(F.count("_s").alias("source_rows"), F.count("_t").alias("target_rows"),
                 F.count(F.when(F.col("_t").isNull(), 1)).alias("missing_in_target"),
                 F.count(F.when(F.col("_s").isNull(), 1)).alias("extra_in_target"),
                 F.count(F.when(both & ~F.col("_s").eqNullSafe(F.col("_t")), 1)).alias("stale_in_target"))


def sync_listing(target: DataFrame) -> DataFrame:
    """What the serving copy shows: its active rows, largest discount first."""
    return target.filter(F.col("is_active")).orderBy(F.col("discount_pct").desc_nulls_first(), F.col("id"))


def require_additive(target: DataFrame, changes: DataFrame) -> None:
    """An incremental sync accepts added columns only."""
    from emporia.operators.versions import schema_changes
    dropped, retyped = schema_changes(target, changes)
    if dropped or retyped:
        raise ValueError(f"incremental sync allows added columns only; dropped={dropped} retyped={retyped}")


def additive_schema_sync(target: DataFrame, changes: DataFrame) -> DataFrame:
    """New columns in ``changes`` are added (NULL for existing rows); a
    dropped or retyped column raises, with the schema diff in the message."""
    require_additive(target, changes)
    return target.unionByName(changes, allowMissingColumns=True)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def keyed_ctas(df: DataFrame, parts: list[str], key: str = "row_key") -> DataFrame:
    """A3: CREATE TABLE AS SELECT sha1(concat(cast(part AS string) ...)) AS key, *.

    A NULL part makes the key NULL (concat semantics); equal parts give equal
    keys, so pair with ``checks.check_unique`` before using it as a key.
    """
    k = F.sha1(F.concat(*[F.col(p).cast("string") for p in parts]))
    return df.select(k.alias(key), *df.columns)
