"""Benchmark decontamination: rare word seeds, then Smith-Waterman alignment.

Benchmark items and documents are sequences of lower-cased words (runs of
letters, digits and underscores, so punctuation and mark-up do not matter).

Texts in Latin letters are cut by byte tables, others by a pattern; the words are the same.

1. The document frequency of every word of the benchmark is counted over all
   documents (partial counts in the tasks, summed by Spark).
2. A passage with ``min_score`` matches a least number of the item's words, so
   it leaves out a bounded number of them. The seeds of an item are its rarest
   words: as many as may be left out, and ``1 + words // 8`` more. That many
   places of seeds at least stand in every passage to be found, however it was
   edited and in whatever document. Frequency only decides which words these
   are: the rarer they are, the less is aligned in vain. It is a rank, not a
   limit: an item that leaked into a third of all documents still has seeds.
   Single words, because changed words break longer n-grams: every third word
   changed leaves no 3-gram, a word put in after each leaves no 2-gram.
3. Where a document holds that many seed places of an item within the longest
   stretch an alignment can have, all of that stretch is aligned locally with
   the item (Smith-Waterman on words: match 2, mismatch -1, gap -1), unless its
   words, each taken as matched if the item has it, cannot reach the score.
4. The alignment's score is divided by that of an exact copy. From
   ``min_score`` on, the passage is reported: copies, and copies with words
   changed, put in or left out. Steps 2 and 3 leave out no such passage.

The benchmark is the query side. It is read in blocks of about ``BLOCK_WORDS``
words, so what is sent to the tasks is bounded whatever its size; documents are
only ever scanned, never shuffled or paired with each other.

Defined results: null or empty texts match nothing. An item of fewer than
``MIN_WORDS`` words is too short to tell a leak from chance and is not looked
for; all others are, also those with a null item_id. Rows that share a doc_id are looked at one by one. Items
with the same text are all reported. Empty tables give an empty result. Extra
columns are not read. Very long texts are searched whole, in time that grows
with their length.
"""

from __future__ import annotations

import re
from itertools import repeat
from math import ceil

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_rows
from emporia.session import scratch_path

MIN_WORDS = 5
MIN_SCORE = 0.5
BLOCK_WORDS = 500_000
MATCH, MISMATCH, GAP = 2, -1, -1

WORD = re.compile(r"\w+")
# Texts of ASCII and of the letters U+00C0 to U+017F are cut by bytes: there, all but these two signs are word characters.
BY_BYTES = bytes(range(0xC0)) + b"\xc3\xc4\xc5"
SIGNS = ("\u00d7".encode(), "\u00f7".encode())
BLANKED = bytes(c if c >= 128 or chr(c).isalnum() or c == ord("_") else 32 for c in range(256))
SCHEMA = "doc_id long, th long, item_id long, score double, first_char long, last_char long"


def words_of(text: str) -> list[bytes]:
    """The runs of ``WORD`` in the lower-cased text, as UTF-8."""
    low = text.lower()
    data = low.encode("utf-8", "surrogatepass")
    if data.translate(None, BY_BYTES) or any(s in data for s in SIGNS):
        return [w.encode("utf-8", "surrogatepass") for w in WORD.findall(low)]
    return data.translate(BLANKED).split()


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(score, first, last) of the best local alignment; places in ``window``. Zero ids never match."""
    score, last = _best(item, window)
    if score <= 0:
        return 0, 0, -1
    _, back = _best(item[::-1], window[last::-1] if last + 1 < len(window) else window[::-1], score)
    return score, last - back, last


def _best(item: np.ndarray, window: np.ndarray, wanted: int | None = None) -> tuple[int, int]:
    """Best score and the place in ``window`` where it ends (the first, or the first with ``wanted``)."""
    n = len(window)
    steps = np.arange(n + 1) * GAP
    row = np.zeros(n + 1, np.int64)
    best, at = 0, -1
    for word in item:
        above = row
        row = np.zeros(n + 1, np.int64)
        row[1:] = above[:-1] + np.where((window == word) & (window > 0), MATCH, MISMATCH)
        np.maximum(row[1:], above[1:] + GAP, out=row[1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row - steps) + steps  # gaps along the window
        k = int(row.argmax())
        if row[k] > best:
            best, at = int(row[k]), k - 1
            if wanted is not None and best >= wanted:
                break
    return best, at


class Searcher:
    """One block of benchmark items: vocabulary and word numbers (0 is any other word)."""

    def __init__(self, items: list[tuple[int, str]], min_score: float = MIN_SCORE):
        self.min_score = min_score
        words = [(i, words_of(t)) for i, t in items]
        words = [(i, w) for i, w in words if len(w) >= MIN_WORDS]
        self.vocab: dict[bytes, int] = {}
        self.items = [(i, np.array([self.vocab.setdefault(x, len(self.vocab) + 1) for x in w], np.int64)) for i, w in words]

    def ids(self, text: str) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))

    def held(self, text: str) -> np.ndarray:
        """Each word of the vocabulary that the text holds, once."""
        words = self.vocab.keys() & set(words_of(text))
        return np.fromiter(map(self.vocab.__getitem__, words), np.int64, len(words))

    def seed(self, df: dict[int, int]) -> None:
        """Choose the seeds of each item by the words' document frequencies."""
        often = np.array([df.get(w, 0) for w in range(len(self.vocab) + 1)], np.int64)
        chosen, of = [], []
        self.worth = np.full(len(self.vocab) + 1, GAP, np.int64)
        #: Of each item: seed places in a passage at least, and words of a passage at most.
        self.least, self.span = np.zeros(len(self.items), np.int64), np.zeros(len(self.items), np.int64)
        for k, (_, w) in enumerate(self.items):
            needed = max(1, ceil(self.min_score * len(w) - 1e-9))  # each match scores MATCH at most
            may_miss = len(w) - needed
            types, counts = np.unique(w, return_counts=True)
            order = np.lexsort((types, often[types]))
            held = np.cumsum(counts[order])
            last = int(np.searchsorted(held, may_miss + min(needed, 1 + len(w) // 8)))
            chosen.append(types[order[:last + 1]])
            of.append(np.full(last + 1, k))
            self.least[k] = held[last] - may_miss
            # All words matched, and as many others between them (-1 each) as the score allows.
            self.span[k] = len(w) + MATCH * len(w) - ceil(self.min_score * MATCH * len(w) - 1e-9)
        word, item = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (chosen, of))
        by_word = np.argsort(word, kind="stable")
        self.posted = item[by_word]  # the items of each seed, from begin[word] on
        self.begin = np.searchsorted(word[by_word], np.arange(len(self.vocab) + 2))

    def stretches(self, ids: np.ndarray):
        """(number of the item, first and one after last word) of what has to be aligned, by item and place."""
        n = self.begin[ids + 1] - self.begin[ids]
        at = np.nonzero(n)[0]
        n = n[at]
        total = int(n.sum())
        item = self.posted[np.arange(total) + np.repeat(self.begin[ids[at]] - np.cumsum(n) + n, n)]
        order = np.argsort(item, kind="stable")
        item, at = item[order], np.repeat(at, n)[order]
        i = np.arange(total)
        j = i + self.least[item] - 1  # a passage that begins with seed place i has j as well
        i, j = i[j < total], j[j < total]
        near = (item[i] == item[j]) & (at[j] - at[i] < self.span[item[i]])
        i, j = i[near], j[near]
        k, span = item[i], self.span[item[i]]
        open_ = None
        for k, a, b in zip(k.tolist(), np.maximum(at[j] - span + 1, 0).tolist(), np.minimum(at[i] + span, len(ids)).tolist()):
            if open_ and open_[0] == k and a <= open_[2]:
                open_ = k, min(a, open_[1]), max(b, open_[2])
                continue
            if open_:
                yield open_
            open_ = k, a, b
        if open_:
            yield open_

    def find(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item_id, score, first and one after last character) of the best passage of each item found in the text."""
        ids = self.ids(text)
        found: dict[int, tuple[int, int, int]] = {}
        for k, a, b in self.stretches(ids):
            item, window = self.items[k][1], ids[a:b]
            wanted = self.min_score * MATCH * len(item)
            self.worth[item] = MATCH
            total = np.cumsum(self.worth[window])
            self.worth[item] = GAP
            if (total - np.minimum(np.minimum.accumulate(total), 0)).max() < wanted:
                continue  # even with every word of the item matched
            score, first, last = align(item, window)
            if score >= wanted and score > found.get(k, (0,))[0]:
                found[k] = score, a + first, a + last
        if not found:
            return []
        spans = [m.span() for m in WORD.finditer(text.lower())]
        return [(self.items[k][0], score / (MATCH * len(self.items[k][1])), spans[first][0], spans[last][1])
                for k, (score, first, last) in sorted(found.items())]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """Lists of (item_id, text) of about ``block_words`` words; each is small enough to be sent to the tasks."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    words = items.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    n_blocks = max(1, -(-words // (6 * block_words)))
    for b in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b) if n_blocks > 1 else items
        found = sorted(((r.item_id, r.text) for r in block.collect()), key=lambda i: (i[0] is not None, i[0] or 0, i[1]))
        if found:
            yield found


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", min_score: float = MIN_SCORE,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, score (0..1), first_char, last_char, th.

    Characters are those of the lower-cased text, end exclusive; ``th`` is a hash of the document's text.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.col(text_col)).alias("th")).filter("text IS NOT NULL")
    path = scratch_path(docs.sparkSession, "llm-leaks")
    docs.sparkSession.createDataFrame([], SCHEMA).write.parquet(path)
    for items in item_blocks(benchmark, item_col, item_text_col, block_words):  # the driver holds one block
        _block_leaks(texts, items, min_score).write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(SCHEMA).parquet(path)


def _block_leaks(texts: DataFrame, items: list[tuple[int, str]], min_score: float) -> DataFrame:
    def count():
        searcher = Searcher(items, min_score)

        def step(batch):
            n = np.zeros(len(searcher.vocab) + 1, np.int64)
            for t in batch.column(0):
                n[searcher.held(t.as_py())] += 1
            w = np.nonzero(n)[0]
            yield {"word": w, "df": n[w]}
        return step

    # At most one row for each word of the block.
    df = {r.word: r.df for r in map_rows(texts.select("text"), "word long, df long", count)
          .groupBy("word").agg(F.sum("df").alias("df")).collect()}

    def search():
        searcher = Searcher(items, min_score)
        searcher.seed(df)

        def step(batch):
            rows = [(d.as_py(), h.as_py(), *hit) for d, t, h in zip(*batch.columns) for hit in searcher.find(t.as_py())]
            if rows:
                doc_id, th, item_id, score, first, last = zip(*rows)
                yield {"doc_id": list(doc_id), "th": list(th), "item_id": list(item_id), "score": list(score),
                       "first_char": list(first), "last_char": list(last)}
        return step

    return map_rows(texts, SCHEMA, search)
