"""Running sums and joins that stay parallel when one key is hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16
#: A key is hot if it holds more than one in so many rows.
HOT_SHARE = 64


def by_ranges(df: DataFrame, partition_cols: list[str], order_cols: list[str]) -> DataFrame:
    """``df`` written once, split by ranges of (partition, order), with the range's number as ``_range``.

    The number must be the same wherever it is used, so the rows are written
    to the shared folder; any subset of them can then be summed again and
    again by ``ranged_sums`` without being sorted into ranges anew.
    """
    from emporia.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "emporia-ranges")
    (df.repartitionByRange(*partition_cols, *order_cols).withColumn("_range", F.spark_partition_id())
       .write.parquet(path))
    return spark.read.parquet(path)


def ranged_sums(ranged: DataFrame, partition_cols: list[str], order_cols: list[str], values: dict[str, Column]) -> DataFrame:
    """Running sums over rows of ``by_ranges``: a prefix sum over the ranges' totals, then one inside each range."""
    names = list(values)
    ranged = ranged.withColumns({f"_v_{k}": c for k, c in values.items()})
    keys = [*partition_cols, "_range"]
    totals = ranged.groupBy(*keys).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in names])
    before = Window.partitionBy(*partition_cols).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in names])
    inner = Window.partitionBy(*keys).orderBy(*order_cols)
    return (ranged.join(offsets, keys)
            .withColumns({k: F.col(f"_o_{k}") + F.sum(f"_v_{k}").over(inner) for k in names})
            .drop(*[f"_v_{k}" for k in names], *[f"_o_{k}" for k in names]))


def running_sum(df: DataFrame, partition_cols: list[str], order_cols: list[str], values: dict[str, Column]) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY p ORDER BY o)`` for each value, split by ranges of the order.

    A plain window puts every row of a key in one task. Here the rows are
    range-partitioned by key *and* order, so a key with a third of the rows
    lies in a third of the partitions, one after the other. Sums per (key,
    partition) -- at most one row per key and partition -- get a prefix sum,
    and the fine running sum runs inside (key, partition) with that offset.
    Rows equal in key and order stay together (and count together, as in a
    RANGE frame).
    """
    named = {f"_in_{k}": c for k, c in values.items()}
    ranged = by_ranges(df.withColumns(named), partition_cols, order_cols)
    return ranged_sums(ranged, partition_cols, order_cols, {k: F.col(f"_in_{k}") for k in values}).drop("_range", *named)


def hot_keys(rows: DataFrame, keys: list[str], share: int = HOT_SHARE) -> DataFrame:
    """The keys that hold more than one in ``share`` of the rows: fewer than ``share`` keys, whatever the data."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.select(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") * share > total).select(*keys)


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, by: Column, how: str = "left", salts: int = SALTS) -> DataFrame:
    """Join a side with hot keys to one with unique keys.

    Only the measured ``hot`` keys (``hot_keys``, over some or all of ``keys``) are
    salted: their left rows go to ``salts`` tasks and their right rows are
    repeated as often; every other row keeps one task and one copy. It is for
    joins whose result is grouped by the same keys; others are left to the
    adaptive skew join, which does not split a partition that is grouped after it.
    """
    on = hot.columns
    marked = F.broadcast(hot.withColumnsRenamed({k: f"_h_{k}" for k in on}).withColumn("_hot", F.lit(True)))  # fewer than HOT_SHARE rows

    def flagged(df: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(marked[f"_h_{k}"]) for k in on])
        return df.join(marked, same, "left").drop(*[f"_h_{k}" for k in on])
    is_hot = F.col("_hot").isNotNull()
    spread = (flagged(right).withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
              .drop("_hot"))
    return (flagged(left).withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).otherwise(F.lit(0))).drop("_hot")
            .join(spread, [*keys, "_salt"], how).drop("_salt"))
