"""Language identification by cross-parsing against suffix automata.

Learning. For each language a bounded sample of labelled text (``sample_chars``
characters, at most ``chars_per_doc`` from one document; documents in the
order of a hash of their id) is turned into a suffix automaton, which accepts
every substring of the sample.

Prediction. A text is parsed greedily into the longest phrases that occur in a
language's sample. The fewer phrases, the closer the text is to that language
(cross-parsing entropy). The number of phrases is normalised by the text's
length, and by what held-in labelled text of that language needs itself, so
that languages with longer or more varied words are not at a disadvantage. The
language with the smallest normalised number wins; ties go to the smaller name.

Each automaton is compiled to a dense transition table whose entries also carry
the phrases that end on the transition, so a batch of texts is parsed side by
side: one table look-up for each character and language. Texts longer than
``BLOCK`` characters are parsed in blocks that all count (a phrase ends at a
block's end). Only the samples are sent to the tasks; they are bounded by
``sample_chars`` x the number of languages.

Defined results: ``und`` with score 0 for a null text or one without a letter,
or if there is nothing to learn from. Otherwise the score is 1 - best / second
best normalised phrase count (1.0 if there is one language). Rows with any
doc_id, also null or repeated, give one row each; a null doc_id counts as not
held out and is not learned from. Extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emporia.llm.common import map_rows, pieces, worker_model

SAMPLE_CHARS = 40_000  # per language, for the automaton
CHECK_CHARS = 20_000  # per language, for its usual phrase count
CHARS_PER_DOC = 1_500
BLOCK = 2048
MAX_LANGUAGES = 200  # those with the most labelled documents, ties by name
DENSE_ENTRIES = 1 << 26  # up to so many (256 MB a worker) transitions are a dense table, beyond it sorted codes
BATCH_CHARS = 6_000_000  # parsed side by side
#: A text that needs this many times a language's usual phrases is in none of the languages (random
#: letters need four times and more; a short text around a long key may need twice as many).
REJECT_AT = 3.5
#: Shorter texts are too short for that: a single letter is a phrase by itself.
REJECT_FROM = 20

SPACE, UNSEEN, FIRST = 0, 1, 2  # codes: any run of non-letters, a letter that no sample has, seen letters


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learning_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    chars: int = SAMPLE_CHARS + CHECK_CHARS, chars_per_doc: int = CHARS_PER_DOC) -> dict[str, list[str]]:
    """lang -> texts, at most ``chars`` characters for each language. Never reads held-out rows.

    The driver gets at most MAX_LANGUAGES x ``chars`` characters, whatever the input's size.
    """
    k = 4 * -(-chars // chars_per_doc)  # documents for each language; many are shorter than chars_per_doc
    labelled = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                            F.xxhash64(F.col(id_col)).alias("at"))
                .filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull() & ~held_out("id")))
    order = Window.partitionBy("lang").orderBy("at", "id")
    known = (labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LANGUAGES)
             .select(F.col("lang").alias("known")))
    labelled = labelled.join(F.broadcast(known), F.col("lang") == F.col("known"), "left_semi")  # MAX_LANGUAGES rows at most
    chosen = (labelled.select("lang", "id", "at").withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
              .select(F.col("id").alias("chosen_id")).distinct())
    rows = (labelled.join(F.broadcast(chosen), F.col("id") == F.col("chosen_id"), "left_semi")
            .groupBy("lang", "at").agg(F.min(F.substring("text", 1, chars_per_doc)).alias("text")).collect())
    found: dict[str, list[str]] = {}
    used: dict[str, int] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.at, r.text)):
        if used.get(r.lang, 0) < chars:
            part = r.text[:chars - used.get(r.lang, 0)]
            found.setdefault(r.lang, []).append(part)
            used[r.lang] = used.get(r.lang, 0) + len(part)
    return found


def suffix_automaton(codes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a code sequence; state 0 is the root."""
    move: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(move)
        move.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in move[p]:
            move[p][c] = cur
            p = link[p]
        if p >= 0:
            q = move[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(move)
                move.append(dict(move[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and move[p].get(c) == q:
                    move[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return move


@lru_cache(1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class CrossParser:
    """Automata of all languages as one table: entry = next state * 4 + phrases ended."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...], dense_entries: int = DENSE_ENTRIES):
        self.langs = [lang for lang, _, _ in samples]
        joined = [" ".join(texts) for _, texts, _ in samples]
        seen = sorted({ord(c) for text in joined for c in text.lower() if c.isalpha()})
        self.code = np.where(letters(), UNSEEN, SPACE).astype(np.uint8 if len(seen) < 250 else np.uint16)
        self.code[seen] = np.arange(FIRST, FIRST + len(seen))
        self.size = FIRST + len(seen)
        moves = [suffix_automaton(self.codes(text).tolist()) for text in joined]
        self.roots = np.concatenate([[0], np.cumsum([len(m) for m in moves])[:-1]]).astype(np.int64) if moves else np.zeros(0, np.int64)
        self.dense = sum(map(len, moves)) * self.size <= dense_entries
        if self.dense:
            self.table = np.concatenate([self._table(m) + 4 * int(r) for m, r in zip(moves, self.roots)]).ravel() if moves else np.zeros(0, np.int32)
        else:
            self._sparse(moves)
        self.usual = np.ones(len(samples))
        for k, (_, _, check) in enumerate(samples):
            n, phrases = self.parse(list(check))
            if n.sum():
                self.usual[k] = phrases[:, k].sum() / n.sum()

    def _table(self, move: list[dict[int, int]]) -> np.ndarray:
        reset = np.zeros(self.size, np.int32)
        known = np.zeros(self.size, bool)
        for c, s in move[0].items():
            reset[c], known[c] = s, True
        # Without a transition the phrase ends and the next one starts with this
        # character; a character that the language never has is a phrase of its own.
        table = np.tile(reset * 4 + np.where(known, 1, 2).astype(np.int32), (len(move), 1))
        table[0] = reset * 4 + np.where(known, 0, 1)
        states = np.fromiter((s for s, m in enumerate(move) for _ in m), np.int64)
        marks = np.fromiter((c for m in move for c in m), np.int64)
        table[states, marks] = np.fromiter((t * 4 for m in move for t in m.values()), np.int32)
        return table

    def _sparse(self, moves: list[list[dict[int, int]]]) -> None:
        """The same transitions as sorted 64-bit codes (state, mark); what a state lacks is what its language does then.

        Memory grows with the samples (two entries of 8 bytes a transition), not with the letters of all languages.
        """
        self.marks = np.concatenate([np.fromiter(((int(r) + s) * self.size + c for s, m in enumerate(move) for c in sorted(m)), np.int64)
                                     for move, r in zip(moves, self.roots)])
        self.entries = np.concatenate([np.fromiter(((int(r) + m[c]) * 4 for m in move for c in sorted(m)), np.int64)
                                       for move, r in zip(moves, self.roots)])
        self.restart = np.repeat((self.roots * 4 + 2)[:, None], self.size, axis=1)
        for k, (move, r) in enumerate(zip(moves, self.roots)):
            for c, s in move[0].items():
                self.restart[k, c] = (int(r) + s) * 4 + 1

    def step(self, state: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Entries of states (a column for each language) and the next marks."""
        if self.dense:
            return self.table[state * self.size + marks[:, None]]
        wanted = state * self.size + marks[:, None]
        at = np.minimum(np.searchsorted(self.marks, wanted), len(self.marks) - 1)
        entry = np.where(self.marks[at] == wanted, self.entries[at], self.restart[:, marks].T)
        # At the root nothing is open: a mark that the language never has is the only phrase that ends.
        return np.where((state == self.roots) & (self.marks[at] != wanted), self.roots * 4 + 1, entry)

    def codes(self, text: str) -> np.ndarray:
        """Codes of the lower-cased text; runs of non-letters are one SPACE, none at the ends."""
        c = self.code[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = c == SPACE
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        c = c[keep]
        if len(c) and c[0] == SPACE:
            c = c[1:]
        return c[:-1] if len(c) and c[-1] == SPACE else c

    def parse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(codes, phrases) of each text: an array, and one with a column for each language."""
        k = len(self.langs)
        coded = [self.codes(t or "") for t in texts]
        n = np.fromiter(map(len, coded), np.int64, len(coded))
        phrases = np.zeros((len(texts), k), np.int64)
        blocks = [(i, c[a:a + BLOCK]) for i, c in enumerate(coded) for a in range(0, len(c), BLOCK)]
        blocks.sort(key=lambda b: -len(b[1]))
        if not blocks:
            return n, phrases
        sizes = np.fromiter((len(b) for _, b in blocks), np.int64, len(blocks))
        grid = np.zeros((sizes[0], len(blocks)), self.code.dtype)  # a row for each step
        for j, (_, b) in enumerate(blocks):
            grid[:len(b), j] = b
        roots = self.roots.astype(np.int32 if self.dense else np.int64)  # a dense table is below 2^31 entries
        state = np.repeat(roots[None, :], len(blocks), axis=0)
        ended = np.zeros((len(blocks), k), np.int32)
        live = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # blocks longer than t
        for t in range(int(sizes[0])):
            m = int(live[t])
            entry = self.step(state[:m], grid[t, :m])
            state[:m] = entry >> 2
            ended[:m] += entry & 3
        ended += state != roots  # the phrase still open
        np.add.at(phrases, np.fromiter((i for i, _ in blocks), np.int64, len(blocks)), ended)
        return n, phrases

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language or und, score, best phrase count against the usual; 0 if too short to tell) of each text."""
        n, phrases = self.parse(texts)
        out = []
        for length, own in zip(n, phrases):
            if not length or not self.langs:
                out.append(("und", 0.0, 0.0))
                continue
            rate = own / length / self.usual
            best = int(np.argmin(rate))
            second = np.min(np.delete(rate, best)) if len(rate) > 1 else np.inf
            excess = float(rate[best]) if length >= REJECT_FROM else 0.0
            out.append((self.langs[best], float(1 - rate[best] / second) if second else 0.0, excess))
        return out


def cross_parser(samples) -> CrossParser:
    """One set of automata for each Python worker."""
    return worker_model(("cross_parser", samples), lambda: CrossParser(samples))


def split_sample(found: dict[str, list[str]], chars: int = SAMPLE_CHARS):
    """Sample texts in two parts: for the automaton, and for the usual phrase count."""
    out = []
    for lang in sorted(found):
        texts, used = found[lang], 0
        total = sum(map(len, texts))
        cut = min(chars, total * 2 // 3)
        k = 0
        while k < len(texts) and used < cut:
            used += len(texts[k])
            k += 1
        out.append((lang, tuple(texts[:k]), tuple(texts[k:] or texts)))
    return tuple(out)


def predictions(docs: DataFrame, samples, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, excess): excess is the best phrase count against the language's usual one."""
    def make():
        parser = cross_parser(samples) if samples else None

        def step(batch):
            sizes = [len(t.as_py() or "") for t in batch.column(1)]
            for a, b in pieces(batch.num_rows, sizes, BATCH_CHARS):
                some = batch.slice(a, b - a)
                found = parser.predict(some.column(1).to_pylist()) if parser else [("und", 0.0, 0.0)] * (b - a)
                yield {"doc_id": some.column(0), "lang_pred": [f[0] for f in found],
                       "score": [f[1] for f in found], "excess": [f[2] for f in found]}
        return step

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                    "doc_id long, lang_pred string, score double, excess double", make)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, excess), one row for each row of ``docs``."""
    samples = split_sample(learning_sample(docs, id_col, text_col, lang_col))
    return (predictions(docs, samples, id_col, text_col)
            .select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "excess"))


def in_known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      reject_at: float = REJECT_AT) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in some learned language.

    Rejected are texts without a letter (und) and those that need more than ``reject_at``
    times the phrases that are usual for the language nearest to them, if they have ``REJECT_FROM`` codes at least.
    """
    samples = split_sample(learning_sample(docs, id_col, text_col, lang_col))
    place = docs.columns.index(text_col)

    def run(batches):
        parser = cross_parser(samples) if samples else None
        for batch in batches:
            texts = batch.column(place)
            sizes = [len(t.as_py() or "") for t in texts]
            for a, b in pieces(batch.num_rows, sizes, BATCH_CHARS):
                some = batch.slice(a, b - a)
                found = parser.predict(some.column(place).to_pylist()) if parser else [("und", 0.0, 0.0)] * (b - a)
                yield some.filter(pa.array([lang != "und" and excess <= reject_at for lang, _, excess in found]))

    return docs.mapInArrow(run, docs.schema)
