"""Token ids in a compact binary format: canonical, length-limited Huffman code.

Writing: documents are range-partitioned and sorted by doc_id, encoded with the
tokenizer, closed with an end id and written once as an id table. The global
counts of the ids (partial counts in the tasks, at most one row for each id of
the vocabulary) give code lengths by package-merge, none above ``MAX_BITS``;
the code is canonical, so the codebook is only (id, length).

File format - a folder of two Parquet tables:

``codebook``: id, bits. Codes are assigned in the order (bits, id).

``blocks`` (in folders part=0, 1, ... that follow each other in doc_id
order, rows in order within): ``first`` (number of ids in all documents before
the block), ``doc_ids``, ``n_tokens`` (ids of each document, end id included),
``checkpoints`` (bit offset of every ``STEP``-th id) and ``payload`` (the
codes, highest bit first). A block holds whole documents, about
``BLOCK_TOKENS`` ids or one longer document, and is decoded on its own.

Reading: a table of 2^MAX_BITS entries gives the id and code length for the
next bits. All checkpoints of a batch of blocks are starting points, so they
are decoded side by side, one id of each in every step.

Driver memory: the codebook (bounded by the vocabulary) and one number for
each partition. No text or id list passes through the driver.

Defined results: a null text is the empty text (only the end id). Rows that share a
doc_id are ordered by a hash of their text; a null doc_id comes first. An
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.bpe import byte_letters, tokenizer_path
from emporia.llm.common import map_rows, pieces, worker_model, written
from emporia.session import scratch_path

BYTE_BPE = "byte_bpe_50k.json"
END_ID = 2
MAX_BITS = 18
BLOCK_TOKENS = 65_536
STEP = 512
BATCH_CHARS = 2_000_000
#: How byte-level BPE splits a text into words (a fixed value of the vocabulary).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBPE:
    """Ids of whole texts, as the tokenizers library gives them for a byte-level BPE file.

    The vocabulary's merges are in the order of their ids, so it can be read as a rank table,
    for which tiktoken finds the same ids four times faster. Texts with special
    strings, or with characters above U+024F (where the two libraries' Unicode tables may
    differ in what a letter is), go through the tokenizers library itself.
    """

    def __init__(self, name: str):
        import tiktoken
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        size = self.lib.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 65_536 else "<u4")
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        as_byte = {w: b for b, w in enumerate(byte_letters())}
        ranks = {bytes([as_byte[c] for c in token]): i for token, i in vocab.items() if token not in self.special}
        self._fast = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self._other = re.compile("[^\0-\u024f]")

    def ids(self, text: str) -> np.ndarray:
        if any([s in text for s in self.special]) or not (text.isascii() or self._other.search(text) is None):
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.dtype)
        return self._fast.encode_to_numpy(text).astype(self.dtype)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes of ``dtype``."""
        return [self.ids(t or "").tobytes() for t in texts]


def byte_bpe(name: str) -> ByteBPE:
    """One tokenizer for each Python worker."""
    return worker_model(("byte_bpe", name), lambda: ByteBPE(name))


def id_table(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """part, start (ids before it in the part), doc_id, n, ids; written, ordered by doc_id over and in the parts."""
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .withColumn("th", F.xxhash64("text"))
               .repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th"))

    def make():
        bpe = byte_bpe(tokenizer)
        end = np.array([end_id], bpe.dtype).tobytes()
        part, width, at = TaskContext.get().partitionId(), bpe.dtype.itemsize, 0

        def step(batch):
            nonlocal at
            sizes = [len(t.as_py() or "") for t in batch.column(1)]
            for i, j in pieces(batch.num_rows, sizes, BATCH_CHARS):
                some = batch.slice(i, j - i)
                ids = [x + end for x in bpe.encode(some.column(1).to_pylist())]
                n = np.array([len(x) // width for x in ids], np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield {"part": np.full(len(n), part, np.int32), "start": starts, "doc_id": some.column(0), "n": n, "ids": ids}
        return step

    return written(map_rows(ordered, "part int, start long, doc_id long, n long, ids binary", make), "ids")


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive counts (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError("more symbols than codes of that length")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, pairs))
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        is_leaf.append(rank < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(is_leaf):  # the cheapest 2n-2 items; each package opens two of the level below
        chosen = int(flags[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (min(take, len(flags)) - chosen)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code: ids with their code lengths."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray, max_bits: int = MAX_BITS):
        order = np.lexsort((ids, bits))
        ids, bits = ids[order], bits[order]
        self.max_bits = max_bits
        size = int(ids.max()) + 1 if len(ids) else 0
        width = np.int64(1) << (max_bits - bits)  # table entries that begin with the code
        first = np.cumsum(width) - width
        self.bits, self.codes = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.bits[ids], self.codes[ids] = bits, first >> (max_bits - bits)
        self.table_id, self.table_bits = np.zeros(1 << max_bits, np.uint32), np.ones(1 << max_bits, np.int64)
        used = int(width.sum())
        self.table_id[:used], self.table_bits[:used] = np.repeat(ids, width), np.repeat(bits, width)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(payload, checkpoints)."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        at = ends - bits
        # A code lies in the 32-bit word where it starts and the next one. Codes are shorter than a
        # word, so one starts in each, and codes never share a bit: a word is the union of its codes.
        word = at >> 5
        place = self.codes[ids].astype(np.uint64) << (64 - (at & 31) - bits).astype(np.uint64)
        both = np.bitwise_or.reduceat(place, np.flatnonzero(np.diff(word, prepend=-1)))
        out = np.zeros(len(both) + 1, np.uint64)
        out[:-1] = both >> np.uint64(32)
        out[1:] |= both & np.uint64(0xFFFFFFFF)
        return out.astype(">u4").tobytes()[:(int(ends[-1]) + 7) // 8], at[::STEP]

    def decode(self, payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int]) -> np.ndarray:
        """The ids of all blocks, one after the other."""
        sizes = np.array([len(p) + 4 for p in payloads], np.int64)
        data = np.frombuffer(b"".join([p + b"\0\0\0\0" for p in payloads]), np.uint8)
        base = (np.cumsum(sizes) - sizes) * 8
        at = np.concatenate([np.asarray(c, np.int64) + b for c, b in zip(checkpoints, base)])
        left = np.concatenate([np.minimum(STEP, n - np.arange(0, n, STEP)) for n in counts])
        out = np.zeros((STEP, len(at)), np.uint32)
        lanes = np.argsort(-left, kind="stable")
        at, live = at[lanes], np.searchsorted(-left[lanes], -np.arange(STEP), side="left")
        word = (data[:-3].astype(np.uint32) << 24 | data[1:-2].astype(np.uint32) << 16
                | data[2:-1].astype(np.uint32) << 8 | data[3:])
        shift = np.uint32(32 - self.max_bits)
        for t in range(int(left.max())):
            m = int(live[t])
            p = at[:m]
            entry = (word[p >> 3] << (p & 7).astype(np.uint32)) >> shift
            out[t, lanes[:m]] = self.table_id[entry]
            p += self.table_bits[entry]
        full = out.T.ravel()
        return full if (left == STEP).all() else full[(np.arange(STEP) < left[:, None]).ravel()]


def write_ids(docs: DataFrame, path: str, tokenizer: str = BYTE_BPE, end_id: int = END_ID, id_col: str = "doc_id",
              text_col: str = "text", max_bits: int = MAX_BITS) -> None:
    """Encode the texts and write them under ``path`` in the format above."""
    spark = docs.sparkSession
    ids = id_table(docs, tokenizer, end_id, id_col, text_col)

    def count():
        dtype = byte_bpe(tokenizer).dtype

        def step(batch):
            for i in range(0, batch.num_rows, 512):
                c = np.bincount(np.frombuffer(b"".join(batch.column(0).slice(i, 512).to_pylist()), dtype))
                found = np.nonzero(c)[0]
                yield {"id": found.astype(np.int32), "n": c[found]}
        return step

    counts = (map_rows(ids.select("ids"), "id int, n long", count)
              .groupBy("id").agg(F.sum("n").alias("n")).toPandas().sort_values("id"))  # one row for each id of the vocabulary
    symbols, bits = counts["id"].to_numpy(np.int64), code_lengths(counts["n"].to_numpy(np.int64), max_bits)
    spark.createDataFrame(list(zip(symbols.tolist(), bits.tolist())), "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    totals = sorted(ids.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one row for each partition
    before, total = {}, 0
    for part, n in totals:
        before[part] = total
        total += n

    def blocks():
        code, dtype = Code(symbols, bits, max_bits), byte_bpe(tokenizer).dtype

        def step(batch):
            part, start, doc_id, n, raw = batch.columns
            n, start, part = n.to_numpy(), start.to_numpy(), part.to_numpy()
            i = 0
            while i < batch.num_rows:
                j, size = i, 0
                while j < batch.num_rows and part[j] == part[i] and (j == i or size + n[j] <= BLOCK_TOKENS):
                    size += n[j]
                    j += 1
                some = np.frombuffer(b"".join(raw.slice(i, j - i).to_pylist()), dtype).astype(np.int64)
                payload, points = code.encode(some)
                yield {"part": [int(part[i])], "first": [before[int(part[i])] + int(start[i])],
                       "doc_ids": [doc_id.slice(i, j - i).to_pylist()], "n_tokens": [n[i:j].tolist()],
                       "checkpoints": [points], "payload": [payload]}
                i = j
        return step

    (map_rows(ids.select("part", "start", "doc_id", "n", "ids"),
              "part int, first long, doc_ids array<long>, n_tokens array<long>, checkpoints array<long>, payload binary", blocks)
     .write.partitionBy("part").option("compression", "none").parquet(f"{path}/blocks"))


def _codebook(spark: SparkSession, path: str, max_bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    rows = spark.read.parquet(f"{path}/codebook").toPandas()
    return rows["id"].to_numpy(np.int64), rows["bits"].to_numpy(np.int64), max_bits


def read_blocks(spark: SparkSession, path: str, schema: str, take, max_bits: int = MAX_BITS) -> DataFrame:
    """Decode every block; ``take(doc_ids, starts, n_tokens, ids)`` gives the columns for its documents."""
    book = _codebook(spark, path, max_bits)
    raw = spark.read.schema("first long, doc_ids array<long>, n_tokens array<long>, checkpoints array<long>, "
                            "payload binary").parquet(f"{path}/blocks")

    def make():
        code = Code(*book)

        def step(batch):
            for i in range(0, batch.num_rows, 16):
                some = batch.slice(i, 16).to_pylist()
                n = [sum(b["n_tokens"]) for b in some]
                ids = code.decode([b["payload"] for b in some], [b["checkpoints"] for b in some], n)
                each = np.concatenate([b["n_tokens"] for b in some]).astype(np.int64)
                firsts = np.concatenate([b["first"] + np.cumsum(b["n_tokens"]) - b["n_tokens"] for b in some]).astype(np.int64)
                yield take([d for b in some for d in b["doc_ids"]], firsts, each, ids)
        return step

    return map_rows(raw, schema, make)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<long>) of every document in the files."""
    def take(doc_ids, starts, n, ids):
        return {"doc_id": doc_ids, "start": starts, "ids": np.split(ids.astype(np.int64), np.cumsum(n)[:-1])}

    return read_blocks(spark, path, "doc_id long, start long, ids array<long>", take)


def id_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    def take(doc_ids, starts, n, ids):
        flat, cuts = ids.astype("<u4").tobytes(), [0, *(4 * np.cumsum(n)).tolist()]
        return {"doc_id": doc_ids, "start": starts, "n_tokens": n,
                "ids_crc32": [zlib.crc32(flat[a:b]) for a, b in zip(cuts, cuts[1:])]}

    return read_blocks(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", take)


def round_trip(docs: DataFrame, tokenizer: str = BYTE_BPE) -> DataFrame:
    """Write the documents' ids, read the files back and give each document's place and checksum."""
    path = scratch_path(docs.sparkSession, "llm-huffman")
    write_ids(docs, path, tokenizer)
    return id_checksums(docs.sparkSession, path)
