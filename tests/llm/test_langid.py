import random
import zlib

import numpy as np
from helpers import SCHEMA, empty_docs, odd_docs, odd_texts, sentence

from emporia.llm import langid as L

SYLLABLES = {"aa": "the an er in on tion re at", "bb": "lich sch ung en ge ver keit ein", "cc": "eau oi tre ch é è ou ment"}


def plain_codes(parser, text):
    kept = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    return [int(parser.code[ord(c)]) for c in " ".join(kept.split())]


def plain_phrases(sample, codes):
    """Greedy longest phrases that occur in the sample; block by block."""
    inside = ",".join(map(str, sample))
    inside = f",{inside},"
    n = 0
    for a in range(0, len(codes), L.BLOCK):
        block, i = codes[a:a + L.BLOCK], 0
        while i < len(block):
            j = i + 1
            while j <= len(block) and f",{','.join(map(str, block[i:j]))}," in inside:
                j += 1
            i = max(i + 1, j - 1)
            n += 1
    return n


def samples(rng, n=40):
    return L.split_sample({lang: [sentence(rng, 20, parts) for _ in range(n)] for lang, parts in SYLLABLES.items()})


def test_phrases_equal_plain_cross_parsing(monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 50)
    rng = random.Random(2)
    learned = samples(rng, 6)
    parser = L.CrossParser(learned)
    texts = [*odd_texts()[:7], "Ünseen letters ж and q", *(sentence(rng, n, p) for n in (1, 5, 60) for p in SYLLABLES.values())]
    n, phrases = parser.parse(texts)
    for t, length, own in zip(texts, n, phrases):
        codes = plain_codes(parser, t)
        assert length == len(codes)
        for k, (_, sample, _) in enumerate(learned):
            assert own[k] == plain_phrases(plain_codes(parser, " ".join(sample)), codes), (t, k)


def test_no_letter_is_und_and_scores_lie_between_0_and_1():
    rng = random.Random(4)
    parser = L.CrossParser(samples(rng))
    for t, (lang, score, _) in zip(odd_texts(), parser.predict(odd_texts())):
        assert (lang == "und") == (not any(c.isalpha() for c in t or "")) and 0 <= score <= 1
    assert L.CrossParser(samples(rng)[:1]).predict(["the an"])[0][:2] == ("aa", 1.0)


def labelled(spark, n=300, seed=5):
    rng = random.Random(seed)
    rows = [(i, sentence(rng, rng.randint(8, 60), SYLLABLES[lang]), lang, "s", 0)
            for i in range(n) for lang in [rng.choice(list(SYLLABLES))]]
    return spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy_and_columns(spark):
    docs = labelled(spark)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = L.identify(docs).collect()
    assert {r.doc_id for r in rows} == set(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out]) >= 0.98 and len(out) > 30


def test_held_out_rows_and_labels_teach_nothing(spark):
    docs = labelled(spark)
    other = docs.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'zz zz' ELSE text END AS text",
                            "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'xx' ELSE lang END AS lang", "source", "n_chars")
    assert L.learning_sample(docs) == L.learning_sample(other)


def test_sample_is_bounded_whatever_repeats(spark):
    taught = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 4 != 2)
    row = (taught, "the an er in on " * 200, "aa", "s", 0)
    docs = spark.createDataFrame([row] * 500, SCHEMA)
    assert sum(map(len, L.learning_sample(docs, chars=4000)["aa"])) <= 4000


def test_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    got = L.identify(docs).collect()
    assert len(got) == docs.count() and all(r.held_out is False for r in got if r.doc_id is None)
    assert L.identify(empty_docs(spark)).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None, None, None)], SCHEMA)
    assert [(r.lang_pred, r.score) for r in L.identify(unlabelled).collect()] == [("und", 0.0)]
    kept = L.in_known_language(docs)
    assert kept.columns == docs.columns and all(any(c.isalpha() for c in r.text) for r in kept.collect())


def test_foreign_text_is_rejected_and_clean_text_stays(spark):
    docs = labelled(spark).unionByName(spark.createDataFrame(
        [(1000, "qxzj vkqp zzkw wqxj kkjq pvzx " * 5, None, None, None), (1001, "123 456", None, None, None)], SCHEMA))
    assert {r.doc_id for r in L.in_known_language(docs).collect()} == set(range(300))


def test_sorted_transitions_equal_the_dense_table():
    rng = random.Random(8)
    learned = samples(rng, 8)
    dense, sparse = L.CrossParser(learned), L.CrossParser(learned, dense_entries=0)
    assert dense.dense and not sparse.dense
    texts = [*odd_texts(), "Ünseen letters ж and q", *(sentence(rng, n, p) for n in (1, 5, 300) for p in SYLLABLES.values())]
    for a, b in zip(dense.parse(texts), sparse.parse(texts)):
        assert (a == b).all()
    assert dense.predict(texts) == sparse.predict(texts)


def test_fifty_languages_with_letters_of_their_own():
    rng = random.Random(9)
    parts = {f"l{k:02d}": " ".join("".join(chr(0x4E00 + 40 * k + rng.randrange(40)) for _ in range(2)) for _ in range(6)) for k in range(50)}
    learned = L.split_sample({lang: [sentence(rng, 20, p) for _ in range(6)] for lang, p in parts.items()})
    sparse = L.CrossParser(learned, dense_entries=1000)
    texts = [sentence(rng, 30, p) for p in parts.values()]
    assert [lang for lang, _, _ in sparse.predict(texts)] == list(parts)
    # Codes pass 2^31 here when states and letters are many; they are 64-bit numbers.
    assert sparse.marks.dtype == np.int64 and (np.diff(sparse.marks) > 0).all()


def test_languages_beyond_the_limit_are_those_with_the_fewest_documents(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 2)
    rows = [(i, "some text here", "c" if i % 7 == 0 else "b" if i % 3 else "a", None, None) for i in range(200)]
    assert sorted(L.learning_sample(spark.createDataFrame(rows, SCHEMA))) == ["a", "b"]


def test_short_clean_texts_are_not_rejected(spark):
    docs = labelled(spark)
    short = spark.createDataFrame([(9000, "A.", "aa", "s", 1), (9001, "x", "aa", "s", 1), (9002, "?", "aa", "s", 1), (9003, "qxzj vkqp zzkw wqxj " * 9, "aa", "s", 1)], SCHEMA)
    kept = {r.doc_id for r in L.in_known_language(docs.unionByName(short)).collect()}
    assert {9000, 9001} <= kept and not {9002, 9003} & kept
