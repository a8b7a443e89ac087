"""Typed, bucketed tables of the session catalog, and merges that leave the target where it lies (keys A4, A9, E8).

A table has its declared schema, a comment and properties in the catalog, and
its rows in Parquet files bucketed by the key. A merge joins the change feed to
the table by bucket: the table is scanned in place, only the feed is exchanged.
The result is written as bucketed files in a new folder, each task its own
bucket, and the catalog entry is pointed to that folder; who reads the old one
is not disturbed. One writer per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.sync import latest_changes
from emporia.session import scratch_path


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_table(spark: SparkSession, name: str, schema: T.StructType, keys: list[str], comment: str | None = None,
                 properties: dict[str, str] | None = None, buckets: int | None = None, path: str | None = None) -> None:
    """A4: an empty table with declared columns (types, NOT NULL, comments), bucketed and sorted by ``keys``.

    ``buckets`` defaults to the session's shuffle partitions: then the exchange
    that finds the newest change of a key already deals the feed out as the
    table's buckets lie, and a merge has one exchange. At 100 TB take as many
    buckets as give files of 0.5 to 1 GB.
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = ", ".join(
        f"{_ident(f.name)} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        + (f" COMMENT {_quoted(f.metadata['comment'])}" if f.metadata.get("comment") else "") for f in schema.fields)
    by = ", ".join(_ident(k) for k in keys)
    spark.sql(f"CREATE TABLE {_ident(name)} ({cols}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {n} BUCKETS "
              f"LOCATION {_quoted(path or scratch_path(spark, 'emporia-table'))}"
              + (f" COMMENT {_quoted(comment)}" if comment else "")
              + (" TBLPROPERTIES (" + ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items()) + ")" if properties else ""))


def describe(spark: SparkSession, name: str) -> dict:
    """What the catalog says of a table: comment, location, bucket count, bucket columns, properties."""
    rows = {r.col_name.strip(): r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(name)}").collect()}
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(name)}").collect()}
    return {"comment": rows.get("Comment"), "location": rows.get("Location"), "buckets": int(rows.get("Num Buckets", 0)),
            "keys": [c.strip(" `") for c in rows.get("Bucket Columns", "[]").strip("[]").split(",") if c.strip(" `")], "properties": props}


def replace_rows(df: DataFrame, name: str, path: str | None = None) -> str:
    """The table's rows become ``df``'s (columns by name, the declared types), in a new folder of bucketed files."""
    spark = df.sparkSession
    about, schema = describe(spark, name), spark.table(name).schema
    path = path or scratch_path(spark, "emporia-table")
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    holder = f"{name}__new"
    (typed.write.format("parquet").bucketBy(about["buckets"], *about["keys"]).sortBy(*about["keys"])
     .option("path", path).mode("errorifexists").saveAsTable(holder))
    spark.sql(f"DROP TABLE {_ident(holder)}")  # its files stay
    spark.sql(f"ALTER TABLE {_ident(name)} SET LOCATION {_quoted(path)}")
    spark.catalog.refreshTable(name)
    return path


def load(df: DataFrame, name: str) -> str:
    """First load of a table: one exchange deals the rows out to their buckets, so each bucket is one file."""
    about = describe(df.sparkSession, name)
    return replace_rows(df.repartition(about["buckets"], *about["keys"]), name)


def merged(spark: SparkSession, name: str, changes: DataFrame, since_version: int | None = None,
           until_version: int | None = None) -> DataFrame:
    """The table's rows after the newest change of each key (deletes remove it), joined by bucket.

    The table side has no exchange and builds no hash table: the feed's newest
    rows of a bucket are built, the table's files streamed past them.
    """
    about, target = describe(spark, name), spark.table(name)
    keys, cols = about["keys"], target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    feed = changes.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in changes.columns])
    rest = [c for c in cols if c not in keys]
    newest = latest_changes(feed, keys, since_version, until_version).select(
        *keys, F.struct(*rest, F.lit(1).alias("_hit")).alias("_new"), (F.col("_change_type") == "delete").alias("_gone"))
    old = target.select(*keys, F.struct(*rest, F.lit(1).alias("_hit")).alias("_old"))
    j = old.join(newest.hint("shuffle_hash"), keys, "full_outer").filter("_gone IS NULL OR NOT _gone")
    row = F.when(F.col("_gone").isNull(), F.col("_old")).otherwise(F.col("_new"))
    return j.select(*keys, row.alias("_row")).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in cols])


def merge(spark: SparkSession, name: str, changes: DataFrame, since_version: int | None = None,
          until_version: int | None = None) -> str:
    """A9 / E8 on a bucketed table: apply the changes in (since, until] and switch the table to the result."""
    return replace_rows(merged(spark, name, changes, since_version, until_version), name)
