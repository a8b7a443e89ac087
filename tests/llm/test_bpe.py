import hashlib
import random

from helpers import empty_docs, odd_docs, odd_texts, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emporia.llm import bpe as B

LETTERS = "aAbé ñ\n\t'sS tT.,%*5²Ⅷ😀日本Σςσİıßﬁé\x1c\x1f\x7f\x00\x85\xa0 ​　<|endoftext|>"
own, lib = B.word_bpe(B.WORD_BPE), Tokenizer.from_file(B.tokenizer_path(B.WORD_BPE))


def check(text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    assert own.encode(text) == ids, text
    assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False), text


def test_odd_texts():
    rng = random.Random(1)
    for t in [*odd_texts(), "a<|endoftext|>b", "<|startoftext|><|endoftext|> x <|end", "Don't WE'LL it's 123 ab1c", "ß" * 300,
              "abab" * 400, "x" * 5000, sentence(rng, 500)]:
        check(t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=60))
def test_equals_the_library(text):
    check(text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_equals_the_library_on_any_text(text):
    if text.encode("utf-8", "ignore").decode() == text:
        check(text)


def test_no_token_has_a_pair_that_is_cut():
    for token in own.vocab:
        assert own.split_word(token.removesuffix(own.end)) == [token.removesuffix(own.end)]


def test_cuts_and_short_and_long_merges_agree():
    rng = random.Random(2)
    for n in (1, 2, 40, 48, 49, 200):
        symbols = [own.vocab[rng.choice("abcdefgh")] for _ in range(n)]
        short = list(symbols)
        while True:  # lowest rank, leftmost
            found = [(own.ranks[p][0], i) for i, p in enumerate(zip(short, short[1:])) if p in own.ranks]
            if not found:
                break
            _, i = min(found)
            short[i:i + 2] = [own.ranks[short[i], short[i + 1]][1]]
        assert B.merge(list(symbols), own.ranks) == short


def test_a_small_memo_changes_nothing():
    rng = random.Random(3)
    text = sentence(rng, 400)
    small = B.WordBPE(B.WORD_BPE, memo=3)
    assert small.encode(text) == own.encode(text)


def test_tables(spark):
    docs = odd_docs(spark)
    want = []
    for r in docs.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, B.encode_digests(docs).collect()), key=repr) == sorted(want, key=repr)
    assert sorted(len(r.ids) for r in B.encode_texts(docs).collect()) == sorted(w[1] for w in want)
    assert B.encode_digests(empty_docs(spark)).count() == 0


def test_a_wrong_id_shows_in_the_decoded_text(monkeypatch):
    """What is decoded comes from the ids: one id off, another token in the text."""
    text = "some plain words here"
    bpe = B.WordBPE(B.WORD_BPE)
    encode = bpe.encode_fragments

    class Off:
        def __init__(self, done):
            self.ids, self.tokens = [done.ids[0] + 1, *done.ids[1:]], done.tokens
    monkeypatch.setattr(bpe, "encode_fragments", lambda keys: [(some, counts, Off(done)) for some, counts, done in encode(keys)])
    parts = bpe.parts([text])[0]
    ids = [int(i) for p in parts for i in p[1].split(" ")]
    right = lib.encode(text, add_special_tokens=False).ids
    assert ids != right and " ".join(p[2] for p in parts) == bpe.decode(ids) != lib.decode(right, skip_special_tokens=False)


def test_special_strings_are_known_from_the_vocabulary():
    assert all(s.startswith(own.mark) for s in own.special)
