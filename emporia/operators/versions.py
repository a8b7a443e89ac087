"""Versions, restore and drift (keys G1-G9).

Branches and point-in-time restore are storage features in the reference.
Here the data side is kept: a change table (see ``operators.sync``) from
which any past state is rebuilt (``as_of``), versioned copies with a manifest
(``sources.store``), row and schema differences, and replayable migrations.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.sync import insert_if_absent, latest_changes

RESTORE_WINDOW_DAYS = 30


class RestoreWindowError(ValueError):
    pass


def as_of(changes: DataFrame, keys: list[str], ts, window_start=None, now=None,
          window_days: int = RESTORE_WINDOW_DAYS) -> DataFrame:
    """The table as it was at ``ts``: newest change per key with
    ``_commit_ts <= ts``, deletes dropped.

    ``window_start`` (or ``now`` - ``window_days``) bounds how far back a
    restore may go; an earlier ``ts`` raises, as a restore outside the
    retention window fails.
    """
    if window_start is None and now is not None:
        window_start = as_time(now) - dt.timedelta(days=window_days)
    if window_start is not None:
        require_in_window(ts, window_start)
    latest = latest_changes(changes, keys, until_ts=ts)
    return latest.filter(F.col("_change_type") != "delete").drop("_change_type", "_commit_version")


def require_in_window(ts, window_start) -> None:
    """A restore point before the retention window raises."""
    if as_time(ts) < as_time(window_start):
        raise RestoreWindowError(f"restore point {ts} is before the window start {window_start}")


def as_time(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


def state_at_version(changes: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Table state after applying every change up to ``version``."""
    latest = latest_changes(changes, keys, until_version=version)
    return latest.filter(F.col("_change_type") != "delete").drop("_change_type", "_commit_version")


def restore_missing(live: DataFrame, recovered: DataFrame, keys: list[str]) -> DataFrame:
    """Copy rows of ``recovered`` whose key is missing in ``live``; live rows are kept."""
    return insert_if_absent(live, recovered.select(*live.columns), keys)


def row_hash(cols: list[str]):
    """xxhash64 over the columns (NULL-aware: the hash sees a null marker)."""
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in cols])


def shared_columns(old: DataFrame, new: DataFrame, keys: list[str]) -> list[str]:
    """Columns beside the keys that both versions have with the same type."""
    types = dict(new.dtypes)
    return [c for c, kind in old.dtypes if c not in keys and types.get(c) == kind]


def row_diff(old: DataFrame, new: DataFrame, keys: list[str], verify: bool = True) -> DataFrame:
    """Keys added, removed or changed between two versions of a table.

    Values are compared over the columns both versions have with the same
    type; added, dropped or retyped columns are ``schema_diff``'s (G5) to
    report and make no row changed. One full outer join on the key carrying a
    64-bit hash of those columns; with ``verify`` the columns themselves are
    compared too, so a hash collision cannot hide a change. Unchanged keys are
    not returned. The join key is the table's primary key, unique on each
    side, so the full outer join (which AQE cannot split for skew) has no hot key.
    """
    cols = shared_columns(old, new, keys)
    mark = F.lit(1).alias("_hit")
    o = old.select(*keys, row_hash([*keys, *cols]).alias("_ho"), *([F.struct(*cols, mark).alias("_vo")] if verify else []))
    n = new.select(*keys, row_hash([*keys, *cols]).alias("_hn"), *([F.struct(*cols, mark).alias("_vn")] if verify else []))
    j = o.join(n, keys, "full_outer")
    changed = F.col("_ho") != F.col("_hn")
    if verify:
        changed = changed | ~F.col("_vo").eqNullSafe(F.col("_vn"))
    kind = (F.when(F.col("_ho").isNull(), F.lit("added"))
            .when(F.col("_hn").isNull(), F.lit("removed"))
            .when(changed, F.lit("changed")))
    return j.select(*keys, kind.alias("change")).filter(F.col("change").isNotNull())


def schema_changes(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str]]:
    """(columns dropped from a to b, columns whose type changed)."""
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    dropped = [c for c in ta if c not in tb]
    retyped = [c for c in ta if c in tb and ta[c] != tb[c]]
    return dropped, retyped


def column_profile(df: DataFrame, cols: list[str], exact: bool = False, lg_k: int = 12) -> DataFrame:
    """(column_name, null_count, distinct_count) of columns of any type, in one aggregate.

    A HyperLogLog sketch for each column, built in the same partial aggregation
    as the null counts: no row is copied, and what is shuffled is one row of
    sketches (2^lg_k bytes a column at most) for each task. Counts below
    2^(lg_k - 3) are exact, others have a relative standard error of about
    1.04 / sqrt(2^lg_k). Values are sketched by two 64-bit hashes, so columns of
    all hashable types count (a map does as its sorted entries). ``exact=True`` counts
    distinct values instead; Spark then copies every row once a column, so it is for few columns.
    """
    def value(c: str):
        kind = df.schema[c].dataType
        return F.array_sort(F.map_entries(c)) if isinstance(kind, T.MapType) else F.col(c)

    def distinct(c: str):
        if exact:
            return F.countDistinct(value(c))
        two = F.concat(F.hex(F.xxhash64(value(c))), F.hex(F.xxhash64(F.lit(1), value(c))))
        return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(F.when(F.col(c).isNotNull(), two), lg_k)), F.lit(0))

    counts = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(F.when(F.col(c).isNull(), 1)).alias(f"n{i}"), distinct(c).alias(f"d{i}"))])
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"), F.col(f"d{i}").alias("distinct_count"))
        for i, c in enumerate(cols)])))


def schema_diff(a: DataFrame, b: DataFrame, profile: bool = False, exact: bool = False) -> DataFrame:
    """(column_name, a_type, b_type, change) for columns only in a, only in b,
    or typed differently. ``profile=True`` adds null and distinct counts per
    differing column (``column_profile``), over the side that has it.
    """
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    rows = []
    for c in list(ta) + [c for c in tb if c not in ta]:
        if c not in tb:
            rows.append((c, ta[c], None, "only_in_a"))
        elif c not in ta:
            rows.append((c, None, tb[c], "only_in_b"))
        elif ta[c] != tb[c]:
            rows.append((c, ta[c], tb[c], "type_changed"))
    spark = a.sparkSession
    diff = spark.createDataFrame(rows, "column_name string, a_type string, b_type string, change string")
    if not profile or not rows:
        return diff
    profiled = [c for c, _, _, _ in rows]
    sides = {c: "a" if change == "only_in_a" else "b" for c, _, _, change in rows}
    found = None
    for side, df in (("a", a), ("b", b)):  # one pass over each side
        own = [c for c in profiled if sides[c] == side]
        if not own:
            continue
        listed = column_profile(df, own, exact)
        found = listed if found is None else found.unionByName(listed)
    return diff.join(found, "column_name", "left")


def replay_migrations(tables: dict[str, DataFrame], steps: list[Callable[[dict], dict]]) -> dict[str, DataFrame]:
    """Apply an ordered list of idempotent steps (tables -> tables).

    Each step must satisfy step(step(x)) == step(x); tests check this.
    """
    for step in steps:
        tables = step(dict(tables))
    return tables


def reset_to_parent(child: dict[str, DataFrame], parent: dict[str, DataFrame],
                    steps: list[Callable[[dict], dict]]) -> dict[str, DataFrame]:
    """Drop the child's state, take the parent's latest, replay the child's steps."""
    del child  # the child's own state is discarded on reset
    return replay_migrations(dict(parent), steps)


def recovery_check(before: DataFrame, after: DataFrame, amount_col: str = "total") -> DataFrame:
    """Row count and revenue before and after a restore, and whether they match.

    Both sides go through one aggregate over a tagged union (no join).
    """
    tagged = (before.select(F.lit(True).alias("_before"), F.col(amount_col).alias("_amt"))
              .unionByName(after.select(F.lit(False).alias("_before"), F.col(amount_col).alias("_amt"))))
    out = tagged.agg(
        F.count(F.when(F.col("_before"), 1)).alias("before_rows"),
        F.coalesce(F.sum(F.when(F.col("_before"), F.col("_amt"))), F.lit(0)).cast("decimal(38,2)").alias("before_revenue"),
        F.count(F.when(~F.col("_before"), 1)).alias("after_rows"),
        F.coalesce(F.sum(F.when(~F.col("_before"), F.col("_amt"))), F.lit(0)).cast("decimal(38,2)").alias("after_revenue"))
    return out.withColumn(
        "match", (F.col("before_rows") == F.col("after_rows")) & (F.col("before_revenue") == F.col("after_revenue")))


def stays(kind: str, at: str, now, retention_days: int = RESTORE_WINDOW_DAYS):
    """Whether a snapshot stays: scheduled ones for the retention, those made by hand until they are deleted by hand."""
    cutoff = F.lit(as_time(now)).cast("timestamp_ntz") - F.make_dt_interval(F.lit(retention_days))
    return (F.col(kind) != "scheduled") | (F.col(at) >= cutoff)


def expire_snapshots(versions: DataFrame, now, retention_days: int = 30) -> DataFrame:
    """A table's versions (``TableStore.versions``) that stay after expiry.

    Scheduled snapshots older than the retention go. Manual snapshots stay
    until they are deleted by hand (their number is limited when they are
    made, see ``TableStore.snapshot``), and versions that are no snapshots
    are not touched.
    """
    cutoff = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(retention_days))
    return versions.filter((F.col("kind") != "snapshot:scheduled") | (F.col("created_at") >= cutoff))
