import heapq
import random
import zlib

import numpy as np
from helpers import empty_docs, odd_docs, odd_texts, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.llm import huffman as H

bpe = H.byte_bpe(H.BYTE_BPE)
LETTERS = "aAbé ñ\n\t'sS tT.,5²😀日 \x1c\x85\xa0 ​　   "


def library(text):
    return bpe.lib.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library():
    rng = random.Random(1)
    texts = [*odd_texts(), "  a  b ", " ", "a ", "a\n b", *(sentence(rng, n) for n in (1, 30, 300))]
    assert [np.frombuffer(x, bpe.dtype).tolist() for x in bpe.encode(texts)] == [library(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=LETTERS, max_size=40), max_size=4))
def test_ids_equal_the_library_on_odd_spacing(texts):
    assert [np.frombuffer(x, bpe.dtype).tolist() for x in bpe.encode(texts)] == [library(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=1, max_size=200))
def test_lengths_are_optimal_without_a_limit_in_reach(counts):
    heap = [(c, 0) for c in counts]  # (weight, cost below)
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[0], heapq.heappop(heap)[0]
        cost += a + b
        heapq.heappush(heap, (a + b, 0))
    bits = H.code_lengths(np.array(counts), 60)
    assert (bits * counts).sum() == (cost if len(counts) > 1 else counts[0])
    limited = H.code_lengths(np.array(counts), 9)
    assert limited.max() <= 9 and (2.0 ** -limited).sum() <= 1


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 70_000), 3000) - 1
    counts = np.bincount(ids)
    symbols = np.nonzero(counts)[0]
    code = H.Code(symbols, H.code_lengths(counts[symbols]))
    parts = [ids[:1], ids[:H.STEP], ids[:H.STEP + 1], ids]
    done = [code.encode(p) for p in parts]
    got = code.decode([p for p, _ in done], [c for _, c in done], [len(p) for p in parts])
    assert got.tolist() == np.concatenate(parts).tolist()
    lone = H.Code(np.array([2]), H.code_lengths(np.array([9])))
    payload, points = lone.encode(np.full(9, 2))
    assert lone.decode([payload], [points], [9]).tolist() == [2] * 9


def expected(rows):
    out, start = [], 0
    for d, t in rows:
        ids = [*library(t), H.END_ID]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_round_trip(spark, scratch):
    rng = random.Random(5)
    rows = [(d * 7 % 101, rng.choice([None, "", sentence(rng, rng.randint(1, 300))])) for d in range(101)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    H.write_ids(docs, scratch + "/ids")
    assert sorted(map(tuple, H.id_checksums(spark, scratch + "/ids").collect())) == expected(sorted(rows, key=lambda r: r[0]))
    ids = {r.doc_id: r.ids for r in H.read_ids(spark, scratch + "/ids").collect()}
    assert ids == {d: [*library(t), H.END_ID] for d, t in rows}
    blocks = spark.read.parquet(scratch + "/ids/blocks").orderBy("part", "first").collect()
    order = [d for b in blocks for d in b.doc_ids]
    assert order == sorted(order) and [b["first"] for b in blocks] == sorted(b["first"] for b in blocks)


def test_long_documents_have_blocks_of_their_own(spark, scratch, monkeypatch):
    rng = random.Random(6)
    rows = [(1, sentence(rng, 20)), (2, sentence(rng, 60_000)), (3, sentence(rng, 20))]
    assert sorted(map(tuple, H.round_trip(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == expected(rows)


def test_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    got = H.round_trip(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == sorted(
        (d, n, c) for d, _, n, c in expected(rows) if d is not None)
    by_start = sorted((r.start, r.n_tokens, r.doc_id) for r in got)
    assert [s for s, _, _ in by_start] == np.cumsum([0, *(n for _, n, _ in by_start)])[:-1].tolist()
    ids = [d for _, _, d in by_start]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert H.round_trip(empty_docs(spark)).count() == 0


def cheapest(counts, limit):
    """The least cost of a prefix code of at most ``limit`` bits: all ways to give sorted counts their lengths."""
    ordered = sorted(counts, reverse=True)  # a cheapest code gives rarer ids no shorter codes

    def best(i, least, room):
        """Least cost of counts[i:] with lengths of ``least`` bits and more, in ``room`` units of 2^-limit."""
        if i == len(ordered):
            return 0
        found = None
        for bits in range(least, limit + 1):
            if (len(ordered) - i) <= room and 2 ** (limit - bits) <= room:
                rest = best(i + 1, bits, room - 2 ** (limit - bits))
                if rest is not None and (found is None or rest + bits * ordered[i] < found):
                    found = rest + bits * ordered[i]
        return found
    return best(0, 1, 2 ** limit)


@settings(max_examples=120, deadline=None)
@given(st.integers(2, 4).flatmap(lambda limit: st.tuples(st.just(limit), st.lists(st.one_of(
    st.integers(1, 5), st.integers(1, 10_000)), min_size=2, max_size=min(9, 2 ** limit)))))
def test_lengths_are_optimal_where_the_limit_binds(case):
    limit, counts = case
    bits = H.code_lengths(np.array(counts), limit)
    assert bits.max() <= limit and (2.0 ** -bits).sum() <= 1
    assert int((bits * counts).sum()) == cheapest(counts, limit)


def test_a_steep_distribution_meets_the_limit():
    counts = [2 ** k for k in range(9)]
    assert H.code_lengths(np.array(counts), 60).max() == 8
    for limit in (4, 5, 6, 7):
        bits = H.code_lengths(np.array(counts), limit)
        assert bits.max() == limit and int((bits * counts).sum()) == cheapest(counts, limit)
