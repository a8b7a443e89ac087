"""Small helpers shared by the operator modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table(t, name: str) -> DataFrame:
    """Fetch a retail table from a ``Tables`` object or a plain dict."""
    if isinstance(t, dict):
        return t[name]
    return getattr(t, name)


def has_table(t, name: str) -> bool:
    if isinstance(t, dict):
        return name in t
    try:
        getattr(t, name)
        return True
    except (AttributeError, KeyError):
        return False


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def top_k(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """ORDER BY ... LIMIT n: planned as TakeOrderedAndProject (per-partition
    top-n, then a merge of n rows per partition), never a full sort."""
    return df.orderBy(*order).limit(n)
