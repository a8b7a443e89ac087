import hashlib
import re

import duckdb
import numpy as np
import pytest
from emporia.llm import fill_middle as M
from helpers import as_set, empty_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")


def brute(doc_id, text, draw=M.Draw()):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{draw.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= draw.rate:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < draw.spm:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=700), st.integers(2, 20))
def test_descent_sums_what_stands_before_each_rank(lengths, span):
    lanes = M.SkipList(np.array(lengths, np.int64), span)
    before = np.concatenate([[0], np.cumsum(lengths)])
    assert [lanes.offset(r) for r in range(len(lengths) + 1)] == before.tolist()
    assert all(w[0].sum() == len(lengths) and w[1].sum() == sum(lengths) for w in lanes.lanes)
    assert len(lanes.lanes[-1][0]) <= span


def test_descent_takes_few_steps_and_refuses_ranks_outside():
    class Counted(np.ndarray):
        steps = 0

        def __getitem__(self, i):
            Counted.steps += 1
            return super().__getitem__(i)
    lanes = M.SkipList(np.ones(100_000, np.int64))
    lanes.lanes = [(u.view(Counted), p) for u, p in lanes.lanes]
    assert lanes.offset(99_999) == 99_999
    assert Counted.steps <= 2 * (M.SPAN + 1) * len(lanes.lanes)
    for bad in (-1, 100_001):
        with pytest.raises(IndexError):
            lanes.offset(bad)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="a\n\ré😀<PSM>"), st.integers(0, 10**6))
def test_cut_equals_plain_lists(text, doc_id):
    digest = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h = tuple(int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    assert (doc_id, *M.cut(text, h)) == brute(doc_id, text)


@pytest.mark.parametrize("draw", [M.Draw(), M.Draw(seed=3, rate=60, spm=20)])
def test_rows_equal_brute_force_and_come_back(spark, draw):
    docs = odd_docs(spark).unionByName(spark.createDataFrame(
        [(100 + i, t) for i, t in enumerate(["a\nb\nc", "no feed", "x<M>\ny", "<P\n>a", "<\n<S", "\r\n\r\n", "日本\n😀\n" * 300])],
        "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = M.transform(docs, draw)
    assert as_set(out, *COLUMNS) == sorted([brute(d, t, draw) for d, t in rows], key=repr)
    back = out.select("doc_id", M.restore(F.col("output"), F.col("form")).alias("text"))
    assert as_set(back, "doc_id", "text") == sorted([(d, t or "") for d, t in rows], key=repr)


def test_one_very_long_text(spark):
    text = "line é\n" * 700_000 + "end"
    docs = spark.createDataFrame([(5, text), (6, "\n" * 1_000_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in M.digests(docs).collect()}
    for d, t in ((5, text), (6, "\n" * 1_000_000)):
        want = brute(d, t)
        assert tuple(got[d])[:5] == want[:5]
        assert got[d].output_sha256 == hashlib.sha256(want[5].encode()).hexdigest()
        assert got[d].restored_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_sql_and_empty_table(spark):
    documents = odd_docs(spark).select("doc_id", "text").toArrow()  # noqa: F841
    want = duckdb.sql(M.oracle_sql()).fetchall()
    assert as_set(M.digests(odd_docs(spark)), "*") == sorted(want, key=repr)
    assert M.digests(empty_docs(spark)).count() == 0
