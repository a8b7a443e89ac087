"""Token counts by a finite-state transducer whose transitions emit numbers of tokens.

The BPE vocabulary is compiled to a deterministic transducer over byte letters.
A state is the fragment read since the last certain cut; the start state stands
between words. Reading a letter

* extends the fragment and emits 0, if the letter pair occurs inside some token;
* otherwise nothing can be merged across the pair: the transition emits the
  number of tokens of the fragment and leads to the letter's own state.

The end of a word emits the number of tokens of its last fragment (with the
word-end mark) and leads back to the start.

States are compiled when they are first reached (as lazy automata of
regular-expression engines do), from the states of shorter fragments: each has its
number of tokens and its last token. Tokens stand next to each other in an encoding
exactly if no merge ever crosses the place between them, which the two tokens alone
decide. So the last token of a fragment is the one end of it that is a token, and that may
follow the last token of what is before; the number is one more than there. No text is
encoded for this, neither by the library nor by merging. States are kept up to a bound; then
compilation starts anew. The numbers of whole runs between blanks are remembered, too, so a
word is stepped through when it is new. What is counted does not depend on what is remembered.

Texts are read in chunks. The map of a chunk says, for any state at its
start, which state follows and how many tokens come out. White space always
leads to the start state, so a map is three parts: the text up to the first
white space (it completes whatever word was open), the number between, and the text
after the last white space (the word left open). Maps are composed pairwise in
a prefix scan of logarithmic depth; the state before each chunk and the total come
from it.

The numbers are those of the ``tokenizers`` library for the same file without
added tokens; special strings inside a text count as one token each, as there.

No shuffle; memory is one Arrow batch and tables of bounded size.

Defined results: a null text counts as the empty text (no bytes, no tokens). Rows with
any doc_id, also null or repeated, give one row each; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.bpe import WORD_BPE, WordBPE, merge
from emporia.llm.common import Memo, map_rows, pieces, worker_model

LIMIT = 2048
CHUNK_CHARS = 1 << 11
STATES = 400_000
RUNS = 150_000  # runs whose numbers are remembered, in each of two generations
PAIRS = 500_000  # pairs of tokens known to be neighbours or not
BATCH_CHARS = 2_000_000
#: A fragment longer than this is counted at its end without states for its prefixes.
LONGEST_STATE = 64

START = 0


class Neighbours:
    """Which tokens may stand next to each other in an encoding.

    While a token's letters are merged, its right edge is a growing part of it,
    and the next token's left edge likewise, each replaced when a merge of some rank takes it
    up. A merge across the place between the two happens if at some time their
    edges are a merge that comes before the ones that take up either edge; among
    equal ranks the left one comes first.
    """

    def __init__(self, bpe: WordBPE):
        self.bpe = bpe
        self.rank = {pair: r for pair, (r, _) in bpe.ranks.items()}
        made: dict[int, int] = {}
        for r, new in sorted(bpe.ranks.values()):
            made.setdefault(new, r)
        # Ranks tell the order in time only if every part was made before it is merged.
        if any(made.get(x, -1) >= r for pair, r in self.rank.items() for x in pair):
            raise ValueError("the vocabulary's merges are out of order")
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.known: dict[tuple[int, int], bool] = {}

    def edges_of(self, token: int):
        """((part, rank of the merge that takes it up), ...) of the left and the right edge; None if no text gives the token."""
        found = self.edges.get(token, 0)
        if found == 0:
            text, end = self.bpe.tokens[token], self.bpe.end
            bare = text.removesuffix(end) if end else text
            letters = [*bare[:-1], bare[-1:] + text[len(bare):]] if bare else [text]
            found = None
            if all(x in self.bpe.vocab for x in letters):
                parts = [self.bpe.vocab[x] for x in letters]
                left, right = [(-1, parts[0])], [(-1, parts[-1])]
                while len(parts) > 1:
                    best = min(((self.rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.rank), default=None)
                    if best is None:
                        break
                    r, i = best
                    new = self.bpe.ranks[parts[i], parts[i + 1]][1]
                    if i == 0:
                        left.append((r, new))
                    if i == len(parts) - 2:
                        right.append((r, new))
                    parts[i:i + 2] = [new]
                if parts == [token]:
                    never = len(self.rank)
                    taken = lambda edge: [(part, edge[k + 1][0] if k + 1 < len(edge) else never) for k, (_, part) in enumerate(edge)]
                    found = taken(left), taken(right)
            self.edges[token] = found
        return found

    def may_follow(self, first: int, second: int) -> bool:
        key = first, second
        known = self.known.get(key)
        if known is None:
            if len(self.known) > PAIRS:
                self.known.clear()
            known = self.known[key] = self._may_follow(first, second)
        return known

    def _may_follow(self, first: int, second: int) -> bool:
        a, b = self.edges_of(first), self.edges_of(second)
        if a is None or b is None:
            return False
        a, b, i, j, rank, never = a[1], b[0], 0, 0, self.rank, len(self.rank)
        while True:
            (x, until_x), (y, until_y) = a[i], b[j]
            r = rank.get((x, y))
            if r is not None and r < until_x and r <= until_y:
                return False
            if until_x == until_y == never:
                return True
            if until_x <= until_y:
                i += 1
            else:
                j += 1


class CountTransducer:
    """The transducer of one vocabulary."""

    def __init__(self, name: str, states: int = STATES, runs: int = RUNS):
        self.bpe = WordBPE(name, memo=0)
        self.near = Neighbours(self.bpe)
        #: Of tokens without and with the word-end mark: each end of a token -> the token it is, or -1.
        self.tails: dict[str, dict[str, int]] = {"": {}, self.bpe.end: {}}
        for text, token in self.bpe.vocab.items():
            marked = self.bpe.end and text.endswith(self.bpe.end) and text != self.bpe.end
            bare = text.removesuffix(self.bpe.end) if marked else text
            known = self.tails[self.bpe.end if marked else ""]
            for i in range(1, len(bare)):
                known.setdefault(bare[i:], -1)
            known[bare] = token
        self.limit = states
        self.runs = Memo(self._new_runs, runs)
        #: Transitions taken so far, and states compiled.
        self.steps = self.compiled = 0
        self._reset()

    def _reset(self) -> None:
        self.fragment: list[str] = [""]  # of each state
        self.move: list[dict[str, tuple[int, int]]] = [{}]  # letter -> (next state, tokens)
        self.tokens: list[tuple[int, int] | None] = [(0, -1)]  # number of tokens of the fragment and the last one, once asked for
        self.at_end: list[int | None] = [0]  # tokens if the word ends here
        self.own: dict[str, int] = {}  # state of a fragment

    def _last_token(self, fragment: str, mark: str) -> tuple[int, int]:
        """(number of tokens, last token) of a fragment all of whose shorter beginnings have states."""
        tails, own, may_follow = self.tails[mark], self.own, self.near.may_follow
        at, ends = len(fragment), []
        while at:  # the ends of the fragment that are tokens, or ends of tokens
            token = tails.get(fragment[at - 1:])
            if token is None:
                break
            at -= 1
            if token >= 0:
                ends.append((at, token))
        while ends:  # the longest first; exactly one fits
            at, token = ends.pop()
            if at:
                count, before = self._tokens_of(own[fragment[:at]])
                if may_follow(before, token):
                    return count + 1, token
            elif self.near.edges_of(token):
                return 1, token
        raise ValueError(f"no token ends {fragment!r}")

    def _tokens_of(self, state: int) -> tuple[int, int]:
        found = self.tokens[state]
        if found is None:
            found = self.tokens[state] = self._last_token(self.fragment[state], "")
        return found

    def _state(self, fragment: str) -> int:
        s = self.own.get(fragment)
        if s is None:
            self.compiled += 1
            s = self.own[fragment] = len(self.fragment)
            self.fragment.append(fragment)
            self.move.append({})
            self.tokens.append(None)
            self.at_end.append(None)
        return s

    def _count(self, fragment: str, last: bool) -> int:
        """Tokens of a fragment without states, by merging."""
        symbols = list(fragment)
        if last:
            symbols[-1] += self.bpe.end
        vocab = self.bpe.vocab
        return len(merge([vocab[x] for x in symbols], self.bpe.ranks))

    def _compile(self, state: int, letter: str) -> tuple[int, int]:
        before = self.fragment[state]
        if not before:
            step = self._state(letter), 0
        elif before[-1] + letter in self.bpe.inside:
            step = self._state(before + letter), 0
        else:
            step = self._state(letter), self._tokens_of(state)[0]
        self.move[state][letter] = step
        return step

    def word(self, word: str) -> int:
        """Tokens of one word in byte letters: start state to start state."""
        if len(word) > LONGEST_STATE:  # the same cuts, without a state for each prefix
            *front, last = self.bpe.split_word(word)
            return sum(self._count(f, False) for f in front) + self._count(last, True)
        if len(self.fragment) > self.limit:
            self._reset()
        state, out, move = START, 0, self.move
        for letter in word:
            step = move[state].get(letter) or self._compile(state, letter)
            state = step[0]
            out += step[1]
        self.steps += len(word) + 1
        n = self.at_end[state]
        if n is None:
            n = self.at_end[state] = self._last_token(self.fragment[state], self.bpe.end)[0] if state else 0
        return out + n

    def run(self, run: str) -> int:
        """Tokens of a run without white space, letter by letter."""
        return sum(map(self.word, self.bpe.words([run])[0])) if run else 0

    def _new_runs(self, runs: list[str]) -> list[int]:
        """``run`` for many runs, which are normalised and split into words together."""
        return [sum(map(self.word, words)) for words in self.bpe.words(runs)]

    def chunk_map(self, chunk: str, runs: list[str] | None = None, known: dict[str, int] | None = None) -> tuple[str, int, str | None]:
        """(head, tokens between, tail); the tail is None if the chunk has no white space."""
        runs = self.bpe.plain_units(chunk) if runs is None else runs
        if not runs:
            return ("", 0, "") if chunk else ("", 0, None)
        white = self.bpe._white
        opens, closes = not white.match(chunk[0]), not white.match(chunk[-1])
        if opens and closes and len(runs) == 1:
            return runs[0], 0, None
        inner = runs[opens:len(runs) - closes]
        known = self.runs.learn(set(inner)) if known is None else known
        return runs[0] if opens else "", sum([known[r] for r in inner]), runs[-1] if closes else ""

    def compose(self, a: tuple[str, int, str | None], b: tuple[str, int, str | None]) -> tuple[str, int, str | None]:
        """The map of a followed by b; associative."""
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        if b[2] is None:
            return a[0], a[1], a[2] + b[0]
        met = a[2] + b[0]
        return a[0], a[1] + self.run(met) + b[1], b[2]

    def prefix_scan(self, maps: list) -> list:
        """Maps of all prefixes, pairwise and then in between."""
        if len(maps) < 2:
            return maps
        pairs = [self.compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)]
        done = self.prefix_scan(pairs)
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(done[i // 2] if i % 2 else self.compose(done[i // 2 - 1], maps[i]))
        return out

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        chunks, places, out = [], [], [0] * len(texts)  # chunks of plain text; (text, first chunk, one after the last)
        for i, t in enumerate(texts):
            t = t or ""
            for k, part in enumerate(self.bpe._special.split(t) if self.bpe.mark in t else [t]):
                if k % 2:
                    out[i] += 1
                elif part:
                    first = len(chunks)
                    chunks += [part[a:a + CHUNK_CHARS] for a in range(0, len(part), CHUNK_CHARS)]
                    places.append((i, first, len(chunks)))
        split = [self.bpe.plain_units(c) for c in chunks]
        known = self.runs.learn(set().union(*split))
        maps = [self.chunk_map(c, runs, known) for c, runs in zip(chunks, split)]
        for i, first, end in places:
            head, between, tail = self.prefix_scan(maps[first:end])[-1]
            out[i] += sum([known[x] if x in known else self.run(x) for x in (head, tail) if x]) + between
        return out

    def count(self, text: str | None) -> int:
        return self.counts([text])[0]


def transducer(name: str) -> CountTransducer:
    """One transducer for each Python worker."""
    return worker_model(("transducer", name), lambda: CountTransducer(name))


def count_tokens(docs: DataFrame, tokenizer: str = WORD_BPE, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row of ``docs``."""
    def make():
        machine = transducer(tokenizer)

        def step(batch):
            texts = batch.column(1).to_pylist()
            for a, b in pieces(len(texts), [len(t or "") for t in texts], BATCH_CHARS):
                n = np.array(machine.counts(texts[a:b]), np.int64)
                yield {"doc_id": batch.column(0).slice(a, b - a), "n_bytes": batch.column(2).slice(a, b - a),
                       "n_tokens": n, "over_limit": n > limit}
        return step

    text = F.col(text_col)
    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                                F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")),
                    "doc_id long, n_bytes long, n_tokens long, over_limit boolean", make)
