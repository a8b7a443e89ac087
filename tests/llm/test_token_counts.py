import random

import pytest
from helpers import empty_docs, odd_docs, odd_texts, sentence
from hypothesis import given, settings
from hypothesis import strategies as st
from test_bpe import LETTERS
from tokenizers import Tokenizer

from emporia.llm import token_counts as T
from emporia.llm.bpe import WORD_BPE, tokenizer_path

machine, lib = T.transducer(WORD_BPE), Tokenizer.from_file(tokenizer_path(WORD_BPE))


def n_tokens(text):
    return len(lib.encode(text or "", add_special_tokens=False).ids)


def test_odd_texts():
    for t in [*odd_texts(), "ab " * 40_000, "a" * 70_000 + " b", "é" * 200]:
        assert machine.count(t) == n_tokens(t)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
@settings(max_examples=60, deadline=None)
@given(text=st.text(alphabet=LETTERS, max_size=50))
def test_any_chunk_size_gives_the_library_count(chunk, text):
    before, T.CHUNK_CHARS = T.CHUNK_CHARS, chunk
    try:
        assert machine.count(text) == n_tokens(text)
    finally:
        T.CHUNK_CHARS = before


def test_composition_is_associative_and_the_scan_has_all_prefixes():
    rng = random.Random(1)
    text = sentence(rng, 60)
    maps = [machine.chunk_map(text[i:i + 5]) for i in range(0, len(text), 5)]
    for a, b, c in zip(maps, maps[1:], maps[2:]):
        assert machine.compose(machine.compose(a, b), c) == machine.compose(a, machine.compose(b, c))
    for i, (head, between, tail) in enumerate(machine.prefix_scan(maps)):
        done = machine.run(head) + between + machine.run(tail or "")
        assert done == n_tokens(text[:5 * (i + 1)])


def test_transitions_emit_at_certain_cuts():
    m = T.CountTransducer(WORD_BPE)
    assert m.word("thé".replace("é", "Ã©")) == n_tokens("thé")
    for state, moves in enumerate(m.move):
        for letter, (_, out) in moves.items():
            before = m.fragment[state]
            assert (out > 0) == bool(before and before[-1] + letter not in m.bpe.inside)


def test_runs_together_equal_the_letters_one_by_one():
    rng = random.Random(4)
    runs = sentence(rng, 200).split() + ["naïveté!", "don't", "日本語", "x" * 200, "12a", "\x1c"]
    assert [machine.run(r) for r in runs] == machine._new_runs(runs) == [n_tokens(r) for r in runs]


def test_every_new_word_is_stepped_through_and_the_library_counts_nothing(monkeypatch):
    rng = random.Random(5)
    text = " ".join(sorted(set(sentence(rng, 3000).lower().replace(".", "").split())))
    want = n_tokens(text)
    m = T.CountTransducer(WORD_BPE)
    for name in ("_lib", "_encoders"):
        monkeypatch.setattr(m.bpe, name, None)  # any use of the library fails
    monkeypatch.setattr(m, "_count", None)  # and so does merging
    assert m.count(text) == want
    least = sum(len(w) + 1 for w in text.split())
    assert least <= m.steps <= 1.05 * least and m.compiled > 0  # words at a chunk's border are parts first
    assert m.count(text) == want


def test_states_have_the_numbers_of_merging():
    m = T.CountTransducer(WORD_BPE)
    rng = random.Random(6)
    for _ in range(400):
        word = "".join(rng.choice("abcdeinorst'Ã©Ġ.1") for _ in range(rng.randint(1, 20)))
        pieces = m.bpe.split_word(word)
        assert m.word(word) == sum(m._count(f, k == len(pieces) - 1) for k, f in enumerate(pieces))
    for s in range(1, len(m.fragment)):
        assert m._tokens_of(s)[0] == m._count(m.fragment[s], False)


def test_tokens_that_follow_each_other_are_those_of_merging():
    m, rng = T.CountTransducer(WORD_BPE), random.Random(7)
    vocab, ranks = m.bpe.vocab, m.bpe.ranks
    bare = [t for t in vocab if not t.endswith(m.bpe.end) and t not in m.bpe.special]
    for _ in range(3000):
        a, b = rng.choice(bare), rng.choice(bare)
        whole = T.merge([vocab[x] for x in a + b], ranks)
        own = [T.merge([vocab[x] for x in t], ranks) == [vocab[t]] for t in (a, b)]
        assert m.near.may_follow(vocab[a], vocab[b]) == (whole == [vocab[a], vocab[b]] and all(own))


def test_ordinary_texts_have_several_chunks_to_compose(spark):
    rng = random.Random(8)
    text = sentence(rng, 2000)
    assert len(text) > 3 * T.CHUNK_CHARS and machine.count(text) == n_tokens(text)


def test_compiling_anew_changes_nothing():
    rng = random.Random(2)
    text = sentence(rng, 300)
    assert T.CountTransducer(WORD_BPE, states=5, runs=2).count(text) == n_tokens(text)


def test_tables(spark):
    docs = odd_docs(spark)
    want = [(r.doc_id, len((r.text or "").encode()), n_tokens(r.text), n_tokens(r.text) > 2048) for r in docs.collect()]
    assert sorted(map(tuple, T.count_tokens(docs).collect()), key=repr) == sorted(want, key=repr)
    assert any(w[3] for w in want) and T.count_tokens(empty_docs(spark)).count() == 0
