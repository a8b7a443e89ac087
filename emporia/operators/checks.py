"""Constraint checks run as jobs (keys F1-F5).

Spark does not enforce PK / UNIQUE / NOT NULL / CHECK / FK, so each check
returns the violating rows (or keys); ``summary`` counts them in one job.
NULLs pass CHECK and FK constraints, as in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """key values that occur more than once, with their count.

    A hash aggregate with partial counts: a key held by a third of the rows
    is counted map-side first.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """rows where any of ``cols`` is NULL, with the list of NULL columns."""
    nulls = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return df.withColumn("null_columns", nulls).filter(F.size("null_columns") > 0)


def check_domain(df: DataFrame, col: str, values=None, low=None, high=None) -> DataFrame:
    """rows whose value is outside an IN-list or a [low, high] range (NULL passes)."""
    return df.filter(violates_domain(col, values, low, high))


def check_foreign_key(child: DataFrame, cols: list[str], parent: DataFrame, keys: list[str]) -> DataFrame:
    """child rows whose key has no parent row (NULL in any key column passes)."""
    p = parent.select(*[F.col(k).alias(c) for k, c in zip(keys, cols)])
    not_null = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return child.filter(not_null).join(p, cols, "left_anti").select(*child.columns)


def cascade_delete(child: DataFrame, cols: list[str], parent: DataFrame, keys: list[str]) -> DataFrame:
    """ON DELETE CASCADE -- keep child rows whose parent survives (or whose key is NULL). The child is read once."""
    p = parent.select(*[F.col(k).alias(c) for k, c in zip(keys, cols)]).distinct().withColumn("_survives", F.lit(True))
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return child.join(p, cols, "left").filter(null_key | F.col("_survives")).select(*child.columns)


def row_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check, violations) of several row checks of one table (a rule is true where it is violated), in one scan."""
    counts = df.agg(*[F.count(F.when(rule, 1)).alias(f"n{i}") for i, rule in enumerate(rules.values())])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"n{i}").alias("violations"))
                                            for i, name in enumerate(rules)])))


def violates_not_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def violates_domain(col: str, values=None, low=None, high=None) -> Column:
    c = F.col(col)
    bad = F.lit(False)
    if values is not None:
        bad = bad | ~c.isin(list(values))
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return c.isNotNull() & bad


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) for several checks, computed in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations")
             for name, df in checks.items()]
    return reduce(DataFrame.unionByName, parts)
