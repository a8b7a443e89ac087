"""Merkle manifest of a dataset: a content-addressed DAG, and leaf proofs by descent from its root.

Every row is a leaf, the digest of its fields. The leaves of a source, by
ascending id, are the lowest nodes of its tree; each ``FAN`` consecutive nodes
become one, whose digest is that of their digests, until one is left: the
source's subroot. The subroots, by source, are the leaves of the top tree.

The manifest stores *records*: digest -> the digests of the children, one table
for each height. A proof needs nothing else. A request names a leaf by its
source's place and its rank in the source; the base-``FAN`` digits of both say
which child to take at each node. The descent starts at the root and joins the
records on the digest; at each step the children not taken are collected, as
what stands left and right of the taken one. Requests that share a node go
down together (one row for each distinct run of leading digits), so a height
has a sixteenth of the rows of the one below. At the leaves the segments are
reversed: a proof runs from leaf to root. Folding a leaf with its proof must
give the root.

Scale: only digests move. Leaves are ranked by ranges of (source, id), so a
source with a third of all rows lies in a third of the partitions; rows that
are equal in all fields are told apart by their place in the written table.
A tree of n leaves takes log16(n) jobs, each a sixteenth of the one before.
Joins on a digest have one record a digest; a digest that stands in very many
places (repeated rows) can be split by the adaptive skew join. The driver gets
one number (the largest source) and the root.

Defined results: fields that are null count as ``-``. Ids ascend with null
first, ties (repeated ids) by leaf digest; rows equal in all fields are leaves
of their own, next to each other. A null source is a source, the first one. An
empty table has no leaves and the digest of nothing as its root. Very long
texts are hashed whole. Columns beside the named ones are not read. A row
whose id is null is never tampered with.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.ids import dense_ids
from emporia.llm.common import written

FAN = 16
#: Base-16 digits: a node's index at the next height is its index shifted by so many bits.
BITS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEGMENT = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(**values: Column) -> Column:
    """The digest of a row's fields, ``FIELDS`` in order."""
    return F.sha2(F.concat(*[field(values.get(f, F.col(f))) for f in FIELDS]), 256)


def _ranked(leaves: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0, by doc_id and leaf within the source) and ``n``, the source's leaves."""
    tagged = written(
        leaves.withColumn("_row", F.monotonically_increasing_id())
              .repartitionByRange("source", "doc_id", "leaf", "_row")
              .sortWithinPartitions("source", "doc_id", "leaf", "_row")
              .withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()).drop("_row"),
        "leaves")
    whole = Window.partitionBy("source")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (tagged.groupBy("source", "_part").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
            .select(F.col("source").alias("_source"), F.col("_part").alias("_at"), "_first",
                    F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("n")))
    return (tagged.join(runs, tagged.source.eqNullSafe(runs._source) & (tagged._part == runs._at))
            .withColumn("rank", F.col("_before") + F.col("_pos") - F.col("_first"))
            .drop("_source", "_at", "_part", "_pos", "_first", "_before"))


def _heights(n: int) -> int:
    return 0 if n <= 1 else 1 + _heights(-(-n // FAN))


def _next_level(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Nodes (keys, idx, n, digest) of trees that are not done -> their parents, with the children."""
    children = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"])
    return (nodes.filter("n > 1")
            .groupBy(*keys, F.shiftright("idx", BITS).alias("up"), F.floor((F.col("n") + FAN - 1) / FAN).alias("n"))
            .agg(children.alias("children"))
            .select(*keys, F.col("up").alias("idx"), "n", F.sha2(F.array_join("children", ""), 256).alias("digest"), "children"))


def _grow(nodes: DataFrame, keys: list[str], largest: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels above ``nodes``, lowest first, and the last nodes of all trees with their ``height``."""
    levels, tops = [], nodes.filter("n = 1").select(*keys, "digest", F.lit(0).alias("height"))
    for height in range(1, _heights(largest) + 1):
        nodes = written(_next_level(nodes, keys), f"{name}-{height}")
        levels.append(nodes)
        tops = tops.unionByName(nodes.filter("n = 1").select(*keys, "digest", F.lit(height).alias("height")))
    return levels, tops


@dataclass
class Manifest:
    """``leaves`` has the input's columns with (rank, n); ``sources`` (source, place, height, subroot);
    ``records[h - 1]`` and ``top_records[h - 1]`` are (digest, children) of height h."""

    leaves: DataFrame
    sources: DataFrame
    records: list[DataFrame]
    top_records: list[DataFrame]
    root: str


def build(leaves: DataFrame) -> Manifest:
    """The manifest of leaves (source, doc_id, leaf, any further columns)."""
    ranked = written(_ranked(leaves), "ranked")
    largest = ranked.agg(F.max("n")).first()[0]
    if largest is None:
        return Manifest(ranked, ranked.sparkSession.createDataFrame([], "source string, place long, height int, subroot string"),
                        [], [], hashlib.sha256(b"").hexdigest())
    levels, tops = _grow(ranked.select("source", F.col("rank").alias("idx"), "n", F.col("leaf").alias("digest")),
                         ["source"], largest, "tree")
    sources = written(dense_ids(tops.withColumnRenamed("digest", "subroot"), ["source"], "place", 0), "sources")
    n = sources.count()
    top = sources.select(F.col("place").alias("idx"), F.lit(n).cast("long").alias("n"), F.col("subroot").alias("digest"))
    top_levels, last = _grow(top, [], n, "top")
    def records(of):
        return [x.select("digest", "children").distinct() for x in of]
    return Manifest(ranked, sources, records(levels), records(top_levels), last.first()["digest"])


def _taken(children: Column, i: Column) -> Column:
    """What stands left and right of the taken child (its place from 0)."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), i), "").alias("left"),
                    F.array_join(F.slice(children, i + 2, F.lit(FAN)), "").alias("right"))


def _down(frontier: DataFrame, records: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """One step of the descent: (keys, idx, digest, path, more) to the wanted children, one segment longer."""
    more = [c for c in frontier.columns if c not in (*keys, "idx", "digest", "path")]
    step = (frontier.join(records, "digest")
            .select(*keys, *more, "idx", "path", "children", F.posexplode("children").alias("i", "digest"))
            .select(*keys, *more, (F.shiftleft("idx", BITS) + F.col("i")).alias("idx"), "digest",
                    F.concat("path", F.array(_taken(F.col("children"), F.col("i")))).alias("path")))
    w = wanted.select(*[F.col(k).alias(f"_{k}") for k in (*keys, "idx")])
    same = reduce(lambda a, b: a & b, [step[k].eqNullSafe(w[f"_{k}"]) for k in (*keys, "idx")])
    return step.join(w, same, "left_semi")


def _prefixes(asked: DataFrame, keys: list[str], heights: int) -> list[DataFrame]:
    """Distinct leading digits of the requests' indices, by height; [0] are the requests themselves."""
    out = [asked.select(*keys, "idx")]
    for h in range(1, heights):
        out.append(written(out[-1].select(*keys, F.shiftright("idx", BITS).alias("idx")).distinct(), f"digits-{h}"))
    return out


def proofs(m: Manifest, requests: DataFrame) -> DataFrame:
    """Requests (source, rank, any further columns) -> the same with ``subroot`` and ``path``.

    ``path`` is the proof from leaf to root: what stands left and right of the
    leaf, then of its parent, and so on. ``requests`` names each leaf once at most.
    """
    spark = requests.sparkSession
    payload = [c for c in requests.columns if c not in ("source", "rank")]
    # Requests of one run of leaves go down as one row.
    runs = written(requests.groupBy("source", F.shiftright("rank", BITS).alias("idx"))
                   .agg(F.collect_list(F.struct("rank", *payload)).alias("asked")), "requests")

    # The top tree, by the digits of the source's place.
    asked = runs.select(F.col("source").alias("_s")).distinct()
    of = m.sources.join(asked, m.sources.source.eqNullSafe(asked._s)).drop("_s")
    places = of.select(F.col("place").alias("idx"))
    digits = _prefixes(places, [], len(m.top_records))
    at = spark.createDataFrame([(0, m.root, [])], f"idx long, digest string, path {SEGMENT}")
    for h in range(len(m.top_records), 0, -1):
        at = _down(at, m.top_records[h - 1], digits[h - 1], [])
    start = written(of.join(at.select(F.col("idx").alias("place"), "digest", "path"), "place")
                    .select("source", "height", F.lit(0).cast("long").alias("idx"), "digest", "subroot", "path"), "subroots")

    # The sources' trees, by the digits of the rank; a tree joins in at its own height.
    digits = _prefixes(runs, ["source"], len(m.records))  # [0]: the runs, the digits at height 1
    down = None
    for h in range(len(m.records), 1, -1):
        here = start.filter(F.col("height") == h).drop("height")
        here = here if down is None else down.unionByName(here)
        down = written(_down(here, m.records[h - 1], digits[h - 2], ["source"]), f"descent-{h}")
    parts = []
    if m.records:
        here = start.filter("height = 1").drop("height")
        here = here if down is None else down.unionByName(here)
        here = here.join(m.records[0], "digest").withColumn("path", F.reverse("path"))
        r = runs.select(F.col("source").alias("_s"), F.col("idx").alias("_i"), "asked")
        met = here.join(r, here.source.eqNullSafe(r._s) & (here.idx == r._i))
        one = met.select("source", "subroot", "path", "children", F.explode("asked").alias("a"))
        digit = F.col("a.rank").bitwiseAND(F.lit(FAN - 1)).cast("int")
        parts.append(one.select("source", "a.*", "subroot", F.concat(F.array(_taken(F.col("children"), digit)), F.col("path")).alias("path")))
    # A lone leaf is its source's subroot.
    alone = start.filter("height = 0").select(F.col("source").alias("_s"), "subroot", F.reverse("path").alias("path"))
    lone = runs.join(alone, runs.source.eqNullSafe(alone._s)).select("source", F.explode("asked").alias("a"), "subroot", "path")
    parts.append(lone.select("source", "a.*", "subroot", "path"))
    return reduce(DataFrame.unionByName, parts).select(*requests.columns, "subroot", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """The digest of a proof: its siblings, level by level from leaf to root, each from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def audit(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every row proved, some after tampering."""
    of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    shown = F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    changed = hit & (shown != F.col("text"))
    m = build(written(of.select("doc_id", "source", leaf_digest().alias("leaf"),
                                F.when(changed, leaf_digest(text=shown)).alias("tampered")), "digests"))
    proved = proofs(m, m.leaves.select("source", "rank", "doc_id", "leaf", "tampered"))
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return (proved.select("doc_id", "leaf", "subroot", F.lit(m.root).alias("root"),
                          siblings_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def oracle_sql() -> str:
    """DuckDB SQL of ``audit``: levels by a recursive query, proofs by windows over them. CRC-32 is computed bit by bit."""
    def digest(text: str) -> str:
        fields = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in FIELDS]
        return "sha256(" + " || ".join(
            f"coalesce(CAST(strlen({x}) AS VARCHAR) || ':' || {x}, '-')" for x in fields) + ")"

    def levels(name: str, base: str, key: str) -> str:
        return f"""
{name} AS (
  SELECT {key}, 0 AS lvl, idx, n, digest FROM {base}
  UNION ALL
  SELECT {key}, lvl + 1, idx // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY {key}, lvl, idx // {FAN}, n),
{name}_seg AS (
  SELECT {key}, lvl, idx,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY {key}, lvl, idx // {FAN} ORDER BY idx))"""

    bit = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda ch: ascii(ch)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
           f"lambda c, _: {bit})), 4294967295)")
    return f"""
WITH RECURSIVE leafs AS (
  SELECT doc_id, source, {digest("text")} AS leaf,
         CASE WHEN {crc} % 5 = 0 THEN {digest(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {digest("text")} END AS shown
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n, leaf AS digest, row_number() OVER () AS row
  FROM leafs),
{levels("tree", "ranked", "source")},
subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, 0 AS top
  FROM tree WHERE n = 1),
{levels("up", "subroots", "top")},
steps AS (
  SELECT x.row, s.lvl, s.l, s.r FROM ranked x
  JOIN tree_seg s ON s.source IS NOT DISTINCT FROM x.source AND s.idx = x.idx // ({FAN} ** s.lvl)::BIGINT
  UNION ALL
  SELECT x.row, 100 + s.lvl, s.l, s.r FROM ranked x
  JOIN subroots u ON u.source IS NOT DISTINCT FROM x.source JOIN up_seg s ON s.idx = u.idx // ({FAN} ** s.lvl)::BIGINT),
path AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY lvl) AS k FROM steps),
folds AS (
  SELECT row, 1 AS k, shown AS acc FROM ranked
  UNION ALL
  SELECT f.row, f.k + 1, sha256(p.l || f.acc || p.r) FROM folds f JOIN path p ON p.row = f.row AND p.k = f.k)
SELECT x.doc_id, x.leaf, u.digest AS subroot, t.digest AS root,
       sha256(coalesce((SELECT string_agg(l || r, '' ORDER BY k) FROM path p WHERE p.row = x.row), '')) AS proof_sha256,
       f.acc AS folded_root, f.acc = t.digest AS verified
FROM ranked x JOIN subroots u ON u.source IS NOT DISTINCT FROM x.source
JOIN (SELECT digest FROM up WHERE n = 1) t ON true
JOIN (SELECT row, arg_max(acc, k) AS acc FROM folds GROUP BY row) f ON f.row = x.row"""
