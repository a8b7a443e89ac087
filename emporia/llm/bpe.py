"""BPE encoding and decoding by forced-boundary splitting.

From the vocabulary comes the set of all byte pairs that stand side by side
inside some token. A pair outside this set can never be merged across, so the
text may be cut between its two bytes wherever it occurs. The fragments
between such cuts are encoded on their own and their ids are joined; repeated
fragments are encoded once, and all new ones of a batch together. White space and the tokenizer's own word splits
are cuts of the same kind (a word's last token ends with the word-end mark, and
nothing follows that mark inside a token).

The ids are those of the ``tokenizers`` library for the same file with
``add_special_tokens=False``; special strings inside a text become their
special ids, as there. Decoding joins the tokens of the ids by one space, the
library's rule for a file without a decoder.

Each row is encoded where it lies: there is no shuffle. Memory in a task is one
Arrow batch and two memos of bounded size.

Defined results: a null text is encoded as the empty text (no ids; both digests are
those of the empty string). Rows with any doc_id, also null or repeated, give
one row each. An empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from functools import cached_property
from hashlib import sha256
from operator import add
from unicodedata import category, normalize

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import Memo, map_rows, pieces, worker_model

WORD_BPE = "word_bpe_49k.json"
MEMO = 120_000  # units and fragments that a worker remembers, in each of two generations
BATCH_CHARS = 2_000_000  # texts whose new fragments are encoded together

#: White space as the tokenizers' patterns know it (Unicode White_Space).
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: str.split() also splits at these four, which are no white space there.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def tokenizer_path(name: str) -> str:
    """``name`` is a file of the installed public_tokenizers package, or a path of its own."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def latin_letters() -> list[str]:
    """The letters from U+00C0 to U+024F (each its own NFC form)."""
    return [c for c in map(chr, range(0xC0, 0x250)) if category(c)[0] == "L" and normalize("NFC", c) == c]


def merge(parts: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges (pair -> rank, new id) to symbol ids: lowest rank first, leftmost among equals."""
    if len(parts) <= 48:
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                r = ranks.get((parts[i], parts[i + 1]))
                if r is not None and (best is None or r[0] < best[0]):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [best[1]]
        return parts
    # Long fragments: a linked list and a heap, n log n.
    n = len(parts)
    left, right, live = [i - 1 for i in range(n)], [i + 1 for i in range(n)], [True] * n
    heap = [(r[0], i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1])))]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i] if live[i] else n
        if j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i] = ranks[a, b][1]
        live[j] = False
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        for p, q in ((left[i], i), (i, right[i])):
            if p >= 0 and q < n and (r := ranks.get((parts[p], parts[q]))):
                heapq.heappush(heap, (r[0], p, parts[p], parts[q]))
    return [parts[i] for i in range(n) if live[i]]


class WordBPE:
    """A word-level BPE vocabulary (tokenizers JSON with a word-end mark)."""

    def __init__(self, name: str, memo: int = MEMO):
        from tokenizers import Tokenizer, models, pre_tokenizers

        path = tokenizer_path(name)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocab | self.special).items()}
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        #: Pairs that occur inside a token; between any other two letters there is a certain cut.
        self.inside: set[str] = set()
        for token in self.vocab:
            bare = token.removesuffix(self.end)
            self.inside.update(bare[i:i + 2] for i in range(len(bare) - 1))
        self._lib = Tokenizer.from_file(path)
        # Fragments inside a word, and those at its end, which take the word-end mark.
        self._encoders = {}
        for last in (False, True):
            mark = {"end_of_word_suffix": self.end} if last and self.end else {}
            self._encoders[last] = Tokenizer(models.BPE(vocab=self.vocab, merges=pairs, **mark))
            self._encoders[last].pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.pairs = pairs
        #: What all special strings begin with: a text without it holds none.
        self.mark = os.path.commonprefix(list(self.special))
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._white = re.compile(f"[{WHITE_SPACE}]+")
        self._fragments = Memo(self._new_fragments, memo)
        self._units = Memo(self._new_units, memo)
        # Letters below U+0250 whose lower case is one such letter: text of these and of
        # printable ASCII is normalised and split here, all other text by the library.
        simple = [c for c in latin_letters() if len(c.lower()) == 1 and ord(c.lower()) < 0x250]
        lower = "".join(sorted({c.lower() for c in simple}))
        self._simple = re.compile(f"[!-~{''.join(simple)}]*")
        self._words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{lower}]+|[0-9]|[^a-z0-9{lower}]+")
        as_letter = byte_letters()
        self._letters = {ord(c): "".join([as_letter[b] for b in c.encode()]) for c in lower}

    @cached_property
    def ranks(self) -> dict[tuple[int, int], tuple[int, int]]:
        """Merges by symbol ids: rank and new id."""
        v = self.vocab
        return {(v[a], v[b]): (i, v[a + b]) for i, (a, b) in reversed(list(enumerate(self.pairs)))}

    def split_word(self, word: str) -> list[str]:
        """The fragments of a word (byte letters) between certain cuts."""
        inside = self.inside
        if inside.issuperset(map(add, word, word[1:])):
            return [word]
        start, out = 0, []
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in inside:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def encode_fragments(self, keys: list[str]):
        """(keys, number of ids of each, all ids, all tokens) of inner and of last fragments; a
        leading blank marks the last fragment of its word. All are encoded in one call."""
        for last in (False, True):
            some = [k for k in keys if (k[0] == " ") == last]
            if some:  # none holds white space: each is a word of its own to the encoder
                done = self._encoders[last].encode("".join(some) if last else " ".join(some), add_special_tokens=False)
                yield some, np.bincount(np.array(done.word_ids, np.int64), minlength=len(some)).tolist(), done

    def _new_fragments(self, keys: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, ids, decoded) of fragments; what is decoded is looked up by the ids."""
        found = {}
        for some, counts, done in self.encode_fragments(keys):
            ids, a = done.ids, 0
            for k, n in zip(some, counts):
                own = ids[a:a + n]
                found[k] = (n, " ".join(map(str, own)), self.decode(own))
                a += n
        return [found[k] for k in keys]

    def words(self, units: list[str]) -> list[list[str]]:
        """The words, in byte letters, of many texts without white space."""
        out: list[list[str]] = []
        rest = []
        for i, u in enumerate(units):
            if self._simple.fullmatch(u):
                w = self._words.findall(u.lower())
                out.append(w if u.isascii() else [x.translate(self._letters) for x in w])
            else:
                out.append([])
                rest.append(i)
        if rest:
            normal = self._lib.normalizer.normalize_str(" ".join([units[i] for i in rest]))
            ends = np.cumsum([len(u) + 1 for u in normal.split(" ")]).tolist()
            k = 0
            for word, (start, _) in self._lib.pre_tokenizer.pre_tokenize_str(normal):
                while start >= ends[k]:
                    k += 1
                out[rest[k]].append(word)
        return out

    def unit_fragments(self, units: list[str]) -> list[list[str]]:
        """The fragments of many texts without white space; a leading blank marks a word's last one."""
        out = []
        for words in self.words(units):
            keys: list[str] = []
            for w in words:
                parts = self.split_word(w)
                parts[-1] = " " + parts[-1]
                keys += parts
            out.append(keys)
        return out

    def _new_units(self, units: list[str]) -> list[tuple[int, str, str]]:
        fragments = self.unit_fragments(units)
        known = self._fragments.learn({k for keys in fragments for k in keys})
        out = []
        for keys in fragments:
            if len(keys) == 1:
                out.append(known[keys[0]])
            else:
                found = [known[k] for k in keys]
                out.append((sum([f[0] for f in found]), " ".join([f[1] for f in found]), " ".join([f[2] for f in found])))
        return out

    def plain_units(self, text: str) -> list[str]:
        """The runs between white space."""
        if any(c in text for c in SEPARATORS):
            return [u for u in self._white.split(text) if u]
        return text.split()

    def text_units(self, text: str) -> list[str]:
        """The runs between white space and special strings; special strings are runs of their own."""
        if self.mark not in text:
            return self.plain_units(text)
        out = []
        for k, part in enumerate(self._special.split(text)):
            out += [part] if k % 2 else self.plain_units(part)
        return out

    def parts(self, texts: list[str | None]) -> list[list[tuple[int, str, str]]]:
        """(number of ids, ids, decoded) of the units of each text in order."""
        split = [self.text_units(t or "") for t in texts]
        known = self._units.learn(set().union(*split) - self.special.keys())
        out = []
        for t, units in zip(texts, split):
            if self.mark in (t or ""):
                out.append([(1, str(self.special[u]), self.tokens[self.special[u]]) if u in self.special else known[u] for u in units])
            else:
                out.append([known[u] for u in units])
        return out

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for _, ids, _ in self.parts([text])[0] if ids for i in ids.split(" ")]

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids])


def word_bpe(name: str) -> WordBPE:
    """One vocabulary for each Python worker."""
    return worker_model(("word_bpe", name), lambda: WordBPE(name))


def _in_batches(bpe: WordBPE, texts: list[str | None]):
    """(first row, parts of the rows' texts) by batches of bounded size."""
    for a, b in pieces(len(texts), [len(t or "") for t in texts], BATCH_CHARS):
        yield a, bpe.parts(texts[a:b])


def encode_texts(docs: DataFrame, tokenizer: str = WORD_BPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded): the operator's own output."""
    def make():
        bpe = word_bpe(tokenizer)

        def step(batch):
            for a, rows in _in_batches(bpe, batch.column(1).to_pylist()):
                ids = [[int(i) for p in r if p[0] for i in p[1].split(" ")] for r in rows]
                yield {"doc_id": batch.column(0).slice(a, len(rows)), "ids": ids, "decoded": [bpe.decode(x) for x in ids]}
        return step

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                    "doc_id long, ids array<int>, decoded string", make)


def encode_digests(docs: DataFrame, tokenizer: str = WORD_BPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of ``encode_texts``' columns, without building them."""
    def make():
        bpe = word_bpe(tokenizer)

        def step(batch):
            for a, rows in _in_batches(bpe, batch.column(1).to_pylist()):
                found = [r if all([p[0] for p in r]) else [p for p in r if p[0]] for r in rows]
                yield {"doc_id": batch.column(0).slice(a, len(rows)),
                       "n_tokens": np.array([sum([p[0] for p in r]) for r in found], np.int64),
                       "ids_sha256": [sha256(" ".join([p[1] for p in r]).encode()).hexdigest() for r in found],
                       "decoded_sha256": [sha256(" ".join([p[2] for p in r]).encode()).hexdigest() for r in found]}
        return step

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
