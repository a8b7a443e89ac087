import random

import duckdb
import pytest
from helpers import SCHEMA, as_set, empty_docs, odd_docs, sentence
from pyspark.sql import functions as F

from emporia.llm import line_chunks as L


def brute(rows, long_words=L.LONG_LINE_WORDS):
    """{(doc_id, text): new text}; rows with the same id and text are one document."""
    seen, kept = set(), {}
    for d, t in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = t.split("\n"), set()
        solid = [i for i, x in enumerate(lines) if x.strip(" \r\t")]
        windows = list(zip(solid, solid[1:])) + [(i, i) for i in solid if lines[i].count(" ") >= long_words - 1]
        for i, j in sorted(windows):
            key = (i == j, *lines[i:j + 1])
            if key in seen:
                gone |= set(range(i, j + 1))
            seen.add(key)
        kept[d, t] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return kept


def corpus(seed=3):
    rng = random.Random(seed)
    block = [sentence(rng, rng.randint(2, 8)) for _ in range(9)]
    paragraph = sentence(rng, 70)
    rows = []
    for d in range(40):
        lines = [sentence(rng, rng.randint(1, 9)) for _ in range(rng.randint(1, 12))]
        if d % 3 == 0:
            k = rng.randint(0, len(lines))
            lines[k:k] = block  # shifted by what is before it
        if d % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), paragraph)
        rows.append((d, "\n".join(lines)))
    return rows + [(40, rows[0][1]), (41, rows[1][1]), (42, ""), (43, "\n\n\n\n")]


def test_equals_brute_force_and_oracle(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = L.dedup_lines(docs)
    want = brute(rows)
    assert {(r.doc_id, r.text) for r in got.collect()} == {(d, x) for (d, _), x in want.items()}
    con = duckdb.connect()
    given = docs.toPandas()  # noqa: F841  read by name in the SQL
    oracle = con.execute(L.oracle_sql(source="given")).fetchall()
    assert sorted(oracle, key=repr) == as_set(got, "doc_id", "text", "n_lines", "n_removed")


def test_a_repeated_block_goes_whatever_stands_before_it(spark):
    rows = corpus()
    block = rows[0][1]
    got = {r.doc_id: r for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[40].text == "" and got[40].n_removed > 0 or got[40].text.count("\n") < block.count("\n")
    assert sum(r.n_removed > 0 for r in got.values()) >= 14  # the block in every third document, the paragraph in every fourth
    assert got[0].n_removed == 0


def test_single_short_lines_and_blank_chunks_stay(spark):
    rows = [(i, "All rights reserved.") for i in range(5)] + [(10 + i, "\n\n\n") for i in range(3)]
    assert {r.n_removed for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}


@pytest.mark.parametrize("k", range(2, 9))
def test_short_passages_go_whole_from_all_documents_but_one(spark, k):
    rng = random.Random(k)
    passage = [sentence(rng, rng.randint(1, 6)) for _ in range(k)]
    rows = [(d, "\n".join([*(sentence(rng, 9) for _ in range(rng.randint(0, 3))), *passage, *(sentence(rng, 9) for _ in range(rng.randint(0, 3)))]))
            for d in range(20)]
    got = {r.doc_id: r for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == rows[0][1] and got[0].n_removed == 0
    for d, t in rows[1:]:
        assert got[d].text == "\n".join(x for x in t.split("\n") if x not in passage) and got[d].n_removed == k


def test_lines_repeated_in_one_text_and_blanks_between(spark):
    rows = [(1, "a\nb\na\nb\nc"), (2, "x\n\n \ny\nz"), (3, "q\nx\n\n \ny"), (4, "x\n\ny"), (5, "r\nr\nr"), (6, "b\n\nq")]
    got = {r.doc_id: r.text for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # 4 differs in the blanks; of 5 one line is left.
    assert got == {1: "a\nb\nc", 2: rows[1][1], 3: "q", 4: rows[3][1], 5: "r", 6: rows[5][1]} == {d: x for (d, _), x in brute(rows).items()}


def test_a_hash_for_two_lines_removes_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "aa\nbb"), (2, "aa\nbb"), (3, "cc\ndd"), (4, "cc\ndd")], "doc_id long, text string")
    bad = docs.filter("doc_id = 1").select(F.xxhash64(F.lit("aa")).alias("h"))
    assert L.ambiguous_hashes(docs).count() == 0
    monkeypatch.setattr(L, "ambiguous_hashes", lambda _: bad)
    assert {r.doc_id: r.n_removed for r in L.dedup_lines(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 2}


def test_very_long_texts(spark):
    long = "\n".join(f"line {i} of many" for i in range(40_000))
    rows = [(1, long), (2, f"head\n{long}\ntail"), (3, "\n" * 100_000), (4, "w " * 200_000)]
    got = {r.doc_id: r for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[2].text == "head\ntail" and got[3].n_removed == got[4].n_removed == 0


def test_odd_rows_and_columns(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = L.dedup_lines(docs).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=repr) == sorted([(d, want.get((d, t), t)) for d, t in rows], key=repr)
    assert [r.n_lines for r in got if r.text is None] == [0] * sum(t is None for _, t in rows)
    kept = L.dedup_rows(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes and kept.count() == docs.count()
    assert L.dedup_lines(empty_docs(spark)).count() == 0 and L.dedup_rows(empty_docs(spark)).columns == empty_docs(spark).columns


def test_rows_keep_their_columns_and_empty_ones_go(spark):
    text = "first line here\nsecond line here\nthird line here\nfourth"
    docs = spark.createDataFrame([(1, text, "en", "a", len(text)), (2, text, "en", "b", len(text)), (3, "", "en", "c", 0)], SCHEMA)
    assert as_set(L.dedup_rows(docs), *docs.columns) == [(1, text, "en", "a", len(text)), (3, "", "en", "c", 0)]


def test_no_python_in_the_plan(spark):
    plan = L.dedup_lines(spark.createDataFrame(corpus(), "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
