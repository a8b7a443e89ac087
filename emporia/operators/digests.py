"""Comparing two versions of a table by digests of key ranges (keys G4, A17, G7).

Every row falls into one of 2^bits ranges of its key's hash. A range's digest
is the number of its rows and order-free sums of two 64-bit row hashes, so it
comes out of a partial aggregation and digests merge: 2^FAN neighbouring
ranges make one of the next height, up to a root. Two trees are compared
from the root down, and only below nodes that differ. Rows are joined, with all
their columns and by value, only in ranges that differ at the lowest height.

Equal tables shuffle 2^bits short rows for each task at most and join nothing. A changed
range is missed only if the count, two xors of 64 bits and a sum of 64-bit
hashes all agree by chance. Keys are a primary key: unique, never NULL; other columns may hold NULLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.operators.versions import row_diff, shared_columns
from emporia.session import scratch_path

#: Ranges of a height that make one of the next, as a power of two.
FAN = 6
PARTS = ("n", "x1", "x2", "s")


def _range(keys: list[str], bits: int):
    return F.shiftrightunsigned(F.xxhash64(*[F.struct(F.col(k).isNull(), F.col(k)) for k in keys]), 64 - bits)


def _merged(digests: DataFrame, by) -> DataFrame:
    return digests.groupBy(by).agg(F.sum("n").alias("n"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("s").alias("s"))


@dataclass
class DigestTree:
    """``levels[0]`` has the digests of all ranges (node, n, x1, x2, s), the last one the root's."""

    levels: list[DataFrame]
    bits: int


def digest_tree(df: DataFrame, keys: list[str], cols: list[str], bits: int = 2 * FAN) -> DigestTree:
    """The digests of a table; the lowest height is written once, the others are sums over it.

    ``bits`` is a multiple of ``FAN``; take one that leaves some thousand rows to a range.
    """
    if bits <= 0 or bits % FAN or bits > 60:
        raise ValueError(f"bits must be a multiple of {FAN} up to 60")
    spark = df.sparkSession
    values = [F.struct(F.col(c).isNull(), F.col(c)) for c in (*keys, *cols)]
    h1, h2 = F.xxhash64(*values), F.xxhash64(F.lit(1), *values)
    rows = df.select(_range(keys, bits).alias("node"), h1.alias("x1"), h2.alias("x2"), F.shiftright(h1, 32).alias("s"), F.lit(1).alias("n"))
    path = scratch_path(spark, "emporia-digests")
    _merged(rows, "node").write.parquet(path)
    levels = [spark.read.parquet(path)]
    for _ in range(bits // FAN):
        levels.append(_merged(levels[-1], F.shiftright("node", FAN).alias("node")))
    return DigestTree(levels, bits)


def differing_ranges(a: DigestTree, b: DigestTree, trace: list | None = None) -> DataFrame:
    """(node) of the ranges whose rows differ, by descent; ``trace`` gets how many nodes each height compared."""
    if a.bits != b.bits:
        raise ValueError("the trees have different ranges")
    spark = a.levels[0].sparkSession
    open_nodes = None
    for x, y in zip(reversed(a.levels), reversed(b.levels)):
        if open_nodes is not None:
            inside = lambda level: level.join(open_nodes, F.shiftright(level.node, FAN) == open_nodes.up, "left_semi")
            x, y = inside(x), inside(y)
        both = x.join(y.select("node", F.struct(*PARTS).alias("_y")), "node", "full_outer")
        differs = both.filter(~F.struct(*PARTS).eqNullSafe(F.col("_y")) | F.col("_y").isNull()).select("node")
        path = scratch_path(spark, "emporia-ranges-differ")
        differs.write.parquet(path)
        found = spark.read.parquet(path)
        if trace is not None:
            trace.append((both.count(), found.count()))
        if found.isEmpty():
            return found
        open_nodes = found.withColumnRenamed("node", "up")
    return found


def row_diff_by_ranges(old: DataFrame, new: DataFrame, keys: list[str], bits: int = 2 * FAN, trace: list | None = None) -> DataFrame:
    """G4 as ``versions.row_diff``, joining only the ranges whose digests differ."""
    cols = shared_columns(old, new, keys)
    nodes = differing_ranges(digest_tree(old, keys, cols, bits), digest_tree(new, keys, cols, bits), trace)

    def inside(df: DataFrame) -> DataFrame:
        return df.join(nodes, _range(keys, bits) == nodes.node, "left_semi")
    return row_diff(inside(old), inside(new), keys)


def sync_verify_by_ranges(source: DataFrame, target: DataFrame, keys: list[str], bits: int = 2 * FAN) -> DataFrame:
    """A17 as ``sync.sync_verify``: counts from the digests, keys from the differing ranges only."""
    cols = [c for c in source.columns if c in target.columns and c not in keys]
    s, t = digest_tree(source, keys, cols, bits), digest_tree(target, keys, cols, bits)
    nodes = differing_ranges(s, t)

    def inside(df: DataFrame) -> DataFrame:
        return df.select(*keys, *cols).join(nodes, _range(keys, bits) == nodes.node, "left_semi")
    change = F.col("change")
    found = row_diff(inside(target), inside(source), keys).agg(
        F.count(F.when(change == "added", 1)).alias("missing_in_target"), F.count(F.when(change == "removed", 1)).alias("extra_in_target"),
        F.count(F.when(change == "changed", 1)).alias("stale_in_target"))
    rows = lambda tree: F.coalesce(tree.levels[-1].select(F.sum("n")).scalar(), F.lit(0)).cast("long")
    return found.select(rows(s).alias("source_rows"), rows(t).alias("target_rows"), "missing_in_target", "extra_in_target", "stale_in_target")


def drift(child: DataFrame, reset: DataFrame, keys: list[str], bits: int = 2 * FAN) -> DataFrame:
    """What a reset discards, one row: rows only the child had, rows it had lost, rows it had changed."""
    change = F.col("change")
    return row_diff_by_ranges(reset, child, keys, bits).agg(
        F.count(F.when(change == "added", 1)).alias("only_in_child"), F.count(F.when(change == "removed", 1)).alias("lost_by_child"),
        F.count(F.when(change == "changed", 1)).alias("changed_by_child"))
