import random
import re

import numpy as np
from helpers import empty_docs, odd_docs, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.llm import decontaminate as D


def plain_score(item, words):
    """Smith-Waterman over the whole text, cell by cell."""
    above, best = [0] * (len(words) + 1), 0
    for a in item:
        row = [0]
        for j, b in enumerate(words):
            row.append(max(0, above[j] + (D.MATCH if a == b else D.MISMATCH), above[j + 1] + D.GAP, row[j] + D.GAP))
        best, above = max(best, *row), row
    return best


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def test_alignment_equals_the_plain_one():
    rng = np.random.default_rng(1)
    for _ in range(200):
        item, window = rng.integers(1, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 30))
        score, first, last = D.align(item, window)
        assert score == plain_score(item.tolist(), [int(w) if w else -1 for w in window])
        if score:
            inner = [int(w) if w else -1 for w in window[first:last + 1]]
            assert plain_score(item.tolist(), inner) == score


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aZ_9 .-\n\t\x1c\x85\xa0ÀÿŸſ×÷Iİßẞµª²Œ’“日Σς\u0301"), st.characters(codec="utf-8"))))
def test_words_by_bytes_equal_the_pattern(text):
    assert [w.decode() for w in D.words_of(text)] == re.findall(r"\w+", text.lower())


def corpus(seed=2):
    rng = random.Random(seed)
    items = [(i, sentence(rng, rng.randint(18, 50))) for i in range(12)] + [(90, "too short"), (91, None), (92, "")]
    docs = []
    for d in range(80):
        text = sentence(rng, 60)
        if d % 4 == 0:
            w = items[d % 12][1].split()
            if d % 8 == 0:  # edited: words changed, put in and left out
                for _ in range(len(w) // 7):
                    w[rng.randrange(len(w))] = rng.choice(["", "zzz", "qqq yyy"])
            text += f" {' '.join(w).upper() if d % 12 == 0 else ' '.join(w)} {sentence(rng, 30)}"
        docs.append((d, text))
    return items, docs


def test_equals_brute_force(spark):
    items, docs = corpus()
    want = {(d, i): plain_score(words(x), words(t)) / (D.MATCH * len(words(x)))
            for d, t in docs for i, x in items if len(words(x)) >= D.MIN_WORDS}
    want = {k: round(v, 6) for k, v in want.items() if v >= D.MIN_SCORE}
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): round(r.score, 6) for r in got.collect()} == want
    assert {d for d, _ in want} == set(range(0, 80, 4))
    in_blocks = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"), block_words=40)
    assert {(r.doc_id, r.item_id) for r in in_blocks.collect()} == set(want)


def test_a_passage_in_most_documents_is_still_found(spark):
    items, docs = corpus()
    docs = [(d, f"{t} {items[3][1]}") for d, t in docs]
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in got.filter("item_id = 3 AND score = 1").collect()} == {d for d, _ in docs}


def test_single_edited_and_partial_copies_equal_brute_force(spark):
    """Each copy stands in one document only, so what an edit breaks stands nowhere."""
    rng = random.Random(7)
    items = [(i, sentence(rng, rng.randint(18, 45))) for i in range(30)]
    docs = []
    for i, text in items:
        w = text.split()
        edit = i % 6
        if edit == 4:  # just the first half, and a word more
            w = w[:len(w) // 2 + 1]
        elif edit == 5:  # a word put in after nearly each
            w = [x for k, y in enumerate(w) for x in ([y, f"put{k}"] if k % 8 else [y])]
        else:  # 10, 15, 20 and 30 % of the words changed, evenly spread
            share = (0.1, 0.15, 0.2, 0.3)[edit]
            w = [f"new{k}" if int((k + 1) * share) > int(k * share) else y for k, y in enumerate(w)]
        docs.append((i, f"{sentence(rng, 20)} {' '.join(w)} {sentence(rng, 20)}"))
    want = {(d, i): plain_score(words(x), words(t)) / (D.MATCH * len(words(x))) for d, t in docs for i, x in items}
    want = {k: round(v, 6) for k, v in want.items() if v >= D.MIN_SCORE}
    assert {d for d, i in want if d == i} == set(range(30))
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): round(r.score, 6) for r in got.collect()} == want


def test_spans_name_the_passage(spark):
    items, docs = corpus()
    text = {d: t.lower() for d, t in docs}
    got = D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    for r in got.filter("score = 1").collect():
        assert words(text[r.doc_id][r.first_char:r.last_char]) == words(dict(items)[r.item_id])


def test_odd_and_empty_tables(spark):
    items, docs = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert D.leaks(odd_docs(spark), bench).count() == 0
    assert D.leaks(empty_docs(spark), bench).count() == 0
    assert D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench.limit(0)).count() == 0
    same = spark.createDataFrame([(1, items[0][1]), (1, items[0][1]), (None, items[0][1])], "doc_id long, text string")
    twice = spark.createDataFrame([(5, items[0][1]), (None, items[0][1])], "item_id long, text string")
    assert sorted(((r.doc_id, r.item_id) for r in D.leaks(same, twice).collect()), key=repr) == [
        (1, 5), (1, 5), (1, None), (1, None), (None, 5), (None, None)]
