"""Approximate nearest neighbours with a permutation index.

Every vector is represented by its ``PREFIX`` nearest pivots in the order of
their closeness (cosine). Vectors near each other see the pivots in a similar
order. In each shard of the index the vectors are posted in inverted files: one
list for each pivot with the vectors that have it in their prefix, and at which
rank. A query goes through the lists of its own pivots and adds up the footrule
distance (the sum of rank differences; a pivot that is missing counts as rank
``PREFIX``). The ``SHARE`` of a shard's vectors with the smallest distance is reranked
by exact cosine in double precision; the shards' best are merged. The share is a least number, no cap:
the distance of its last one is the limit, and what lies within ``MARGIN`` of the limit, or nearer than
``NEAR``, is reranked too, however much it is (both as parts of the largest distance). So a large group of
near copies, which all have about the same distance, is never cut by a tie or by the digits that differ. Memory
stays bounded, since a shard is.

Pivots come from a bounded, documented sample (``SAMPLE`` vectors, those with
the smallest hash of their id): ``PIVOTS`` of them, in that order, none close to another. Every vector is indexed, in whichever shard it
lies; the share is a fraction, so the work of a query follows the number of
vectors. Queries are taken in blocks of about ``QUERY_BLOCK``, so what is
sent to the tasks is bounded; a block's answers are ``k`` rows for each query and
shard.

Identical vectors share their prefix; ties in footrule are all reranked, ties in cosine go to the smaller
vec_id, in the shards and in the merge.

Defined results: vectors that are null, zero, or hold a null or non-finite component take no
part, neither as queries nor as candidates; nor do rows with a null vec_id. Rows with
the same vec_id and vector are one vector; a vec_id with several vectors takes part
with each. Vectors of another length than a query's are not its candidates. An
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emporia.llm.common import map_rows, written
from emporia.session import scratch_path

PIVOTS = 256
SAMPLE = 2048  # vectors from which the pivots are taken
NEAR_PIVOT = 0.8  # cosine from which a second pivot would tell nothing new
PREFIX = 96
SHARE = 0.15
MARGIN = 0.02  # beyond the share's last distance, of the largest footrule distance
NEAR = 0.25  # near copies: unrelated vectors differ by about half of the largest distance and more
LEAST = 256  # candidates of a shard at least (all, if it has fewer)
K = 5
QUERY_EVERY = 50
QUERY_BLOCK = 4096
SHARD_ROWS = 8192
FOUND = "query_id long, variant int, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def prefixes(units: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, nearest first."""
    length = min(length, len(pivots))
    return np.argsort(-(units @ pivots.T), axis=1, kind="stable")[:, :length].astype(np.int16)


def spread(units: np.ndarray, count: int) -> np.ndarray:
    """Numbers of up to ``count`` vectors, in order, that are not close to one chosen before (then any others)."""
    chosen: list[int] = []
    for i in range(len(units)):
        if len(chosen) < count and (not chosen or (units[chosen] @ units[i]).max() < NEAR_PIVOT):
            chosen.append(i)
    rest = [i for i in range(len(units)) if i not in set(chosen)]
    return np.array(chosen + rest[:count - len(chosen)], np.int64)


class Shard:
    """Inverted files over the distinct vectors of some rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, pivots: np.ndarray, prefix: int):
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], np.ascontiguousarray(rows[order])
        whole = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel()
        _, first, same = np.unique(whole, return_index=True, return_inverse=True)
        rank = np.argsort(np.argsort(first))  # distinct vectors by their smallest vec_id
        by_vector = np.argsort(rank[same], kind="stable")
        self.ids, self.rows = ids[by_vector], rows[np.sort(first)]
        self.begin = np.searchsorted(rank[same][by_vector], np.arange(len(first) + 1))  # ids of each vector
        self.units = _unit(self.rows)
        self.prefix = min(prefix, len(pivots))
        flat = prefixes(self.units, pivots, prefix).ravel()
        by_pivot = np.argsort(flat, kind="stable")
        ends = np.searchsorted(flat[by_pivot], np.arange(len(pivots) + 1))
        who, at = (by_pivot // self.prefix).astype(np.int32), (by_pivot % self.prefix).astype(np.int32)
        self.posted = [(who[a:b], at[a:b]) for a, b in zip(ends, ends[1:])]

    def footrule(self, own: np.ndarray) -> np.ndarray:
        """Distance of every vector of the shard to a query's prefix."""
        n = self.prefix
        # Start as if nothing were shared; each shared pivot takes off what it had cost on both sides.
        d = np.full(len(self.rows), n * (n + 1), np.int32)
        for rank, pivot in enumerate(own.tolist()):
            who, at = self.posted[pivot]
            d[who] += np.abs(at - rank) + (at + rank - 2 * n)
        return d

    def nearest(self, query_id: int, row: np.ndarray, unit: np.ndarray, own: np.ndarray, k: int,
                share: float) -> tuple[list[int], list[float]]:
        """(vec_ids, cosines) of the best k rows among the candidates."""
        want = max(LEAST, k + 1, int(np.ceil(share * len(self.rows))))
        if want >= len(self.rows):
            chosen = np.arange(len(self.rows))
        else:
            d = self.footrule(own)
            largest = self.prefix * (self.prefix + 1)
            limit = max(np.partition(d, want - 1)[want - 1] + MARGIN * largest, NEAR * largest)
            chosen = np.nonzero(d <= limit)[0]
        rough = self.units[chosen] @ unit
        if len(chosen) > k + 1:  # all within rounding of the k+1st go on to the exact score
            chosen = chosen[rough >= np.partition(rough, -(k + 1))[-(k + 1)] - 1e-9]
        exact = cosine(row, self.rows[chosen])
        # The first k + 1 ids of a vector are enough: a query takes k, and one may be its own.
        rows = [(i, s) for c, s in zip(chosen.tolist(), exact.tolist())
                for i in self.ids[self.begin[c]:min(self.begin[c + 1], self.begin[c] + k + 1)].tolist() if i != query_id]
        rows.sort(key=lambda r: (-r[1], r[0]))
        return [i for i, _ in rows[:k]], [s for _, s in rows[:k]]


def _by_length(ids: np.ndarray, vectors: list[np.ndarray]):
    lengths = np.array([len(v) for v in vectors])
    for n in np.unique(lengths):
        at = np.nonzero(lengths == n)[0]
        yield int(n), ids[at], np.array([vectors[i] for i in at], np.float64)


def cosine(a: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of a vector with each row, in double precision on the original vectors."""
    s, t = np.abs(a).max(), np.abs(rows).max(axis=1)  # scaled, so that squares neither overflow nor vanish
    a, rows = a / s, rows / t[:, None]
    dot, rr = (rows * a).sum(axis=1), (rows * rows).sum(axis=1)
    return np.clip(dot / np.sqrt(rr * (a * a).sum()), -1.0, 1.0)


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = QUERY_EVERY, k: int = K,
           pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every vector whose id is divisible by ``every``."""
    base = usable(vectors, id_col, vector_col).dropDuplicates(["vec_id", "v"])
    n = base.count()
    shards = max(1, -(-n // SHARD_ROWS))
    index = written(base.repartition(shards, F.xxhash64("vec_id")), "vectors")
    sample = [tuple(r.v) for r in index.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).collect()]
    asked = index.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // query_block))
    path = scratch_path(vectors.sparkSession, "llm-found")
    for b in range(blocks):  # one block after the other, so the driver holds one
        some = asked.filter(F.pmod(F.xxhash64("vec_id", F.lit(17)), F.lit(blocks)) == b) if blocks > 1 else asked
        queries = sorted((r.vec_id, tuple(r.v)) for r in some.collect())  # about query_block rows
        _search_block(index, queries, sample, k, pivots, prefix, share).write.mode("append").parquet(path)
    found = vectors.sparkSession.read.schema(FOUND).parquet(path)
    order = Window.partitionBy("query_id", "variant").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search_block(index: DataFrame, queries, sample, k: int, pivots: int, prefix: int, share: float) -> DataFrame:
    def make():
        by_length = {}
        q_ids = np.array([q for q, _ in queries], np.int64)
        for n, ids, rows in _by_length(q_ids, [np.array(v) for _, v in queries]) if queries else ():
            own = np.array([p for p in sample if len(p) == n], np.float64)
            # Without sampled vectors of that length the queries' own serve.
            own = _unit(own if len(own) else rows[:SAMPLE])
            own = own[spread(own, pivots)]
            units = _unit(rows)
            by_length[n] = ids, rows, units, own, prefixes(units, own, prefix)
        variants: dict[tuple, int] = {}  # tells the vectors of one vec_id apart
        count: dict[int, int] = {}
        for q, v in queries:
            variants[q, v] = count[q] = count.get(q, -1) + 1

        def step(batch):
            vectors = [np.array(v, np.float64) for v in batch.column(1).to_pylist()]
            for n, ids, rows in _by_length(batch.column(0).to_numpy(), vectors):
                if n not in by_length:
                    continue
                asked, asked_rows, units, own, firsts = by_length[n]
                shard = Shard(ids, rows, own, prefix)
                out = {"query_id": [], "variant": [], "vec_id": [], "score": []}
                for q, row, unit, first in zip(asked.tolist(), asked_rows, units, firsts):
                    found, score = shard.nearest(q, row, unit, first, k, share)
                    out["query_id"] += [q] * len(found)
                    out["variant"] += [variants[q, tuple(row.tolist())]] * len(found)
                    out["vec_id"] += found
                    out["score"] += score
                yield out
        return step

    return map_rows(index, FOUND, make)
