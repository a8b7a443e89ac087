"""Fill-in-the-middle transformation by an indexable skip list over lines.

A text is a list of units, its lines with their line feeds. Two ranks are
drawn for each document from a hash of its id; the units before the smaller
one are the prefix, those up to the larger one the middle, the rest the
suffix. The parts are put behind marks in one of two orders (``psm``, ``spm``),
or the text stays as it is (``plain``).

To cut at a rank, the text's characters before that unit must be known. The
skip list's lowest lane has a link for each unit; every ``SPAN``-th node also
stands in the lane above, until a lane has ``SPAN`` links at most. A link
carries two widths: the units and the code points it passes. From the top
lane, a descent follows links as long as the units passed stay within the
rank, then goes one lane down at the same node; at the end it stands at the
rank exactly and has summed the code points before it, in ``SPAN`` steps a lane at most.

Scale: each row by itself, no shuffle. Arrow batches are worked through in
pieces of about ``BATCH_CHARS`` characters; a text's lanes take about ten bytes a
character in the worst case (a text of line feeds only), so one very long text
needs several times its own size.

Defined results: a null text is an empty one. A null id is hashed as no digits.
A text without a line feed is one unit; marks inside a text make it plain, so
``restore`` is exact for every text. Rows are taken one by one, so repeated
rows give equal rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_rows, pieces

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Every so many nodes of a lane also stand in the lane above.
SPAN = 16
BATCH_CHARS = 1 << 24


@dataclass(frozen=True)
class Draw:
    """How many documents in a hundred are transformed, how many of those as spm, and the hash's seed."""

    seed: int = 7
    rate: int = 100
    spm: int = 50


class SkipList:
    """An indexable skip list over units of given lengths in code points."""

    def __init__(self, lengths: np.ndarray, span: int = SPAN):
        self.span = span
        self.n = len(lengths)
        #: Lowest first: (units, code points) that each link of the lane passes.
        self.lanes = [(np.ones(self.n, np.int64), np.asarray(lengths, np.int64))]
        while len(self.lanes[-1][0]) > span:
            at = np.arange(0, len(self.lanes[-1][0]), span)
            self.lanes.append(tuple(np.add.reduceat(w, at) for w in self.lanes[-1]))

    def offset(self, rank: int) -> int:
        """Code points before the unit of that rank (0 to n)."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        node = units = points = 0
        for unit_width, point_width in reversed(self.lanes):
            node *= self.span  # the same place one lane down
            while node < len(unit_width) and units + unit_width[node] <= rank:
                units += int(unit_width[node])
                points += int(point_width[node])
                node += 1
        return points


def unit_lengths(text: str) -> np.ndarray:
    """Code points of each line with its line feed; what follows the last feed is a unit if not empty."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.flatnonzero(codes == 10) + 1
    if len(codes) and (not len(ends) or ends[-1] != len(codes)):
        ends = np.append(ends, len(codes))
    return np.diff(ends, prepend=0)


def cut(text: str, h: tuple[int, int, int, int], draw: Draw = Draw()) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix length, middle length, output) of one text."""
    units = SkipList(unit_lengths(text))
    n = units.n
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h[2] % 100 >= draw.rate:
        return n, "plain", None, None, text
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = units.offset(first), units.offset(last)
    if h[3] % 100 < draw.spm:
        return n, "spm", a, b - a, "".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
    return n, "psm", a, b - a, "".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))


def transform(docs: DataFrame, draw: Draw = Draw(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): each document in its form."""
    doc_id = F.col(id_col).cast("long")
    digest = F.sha2(F.concat(F.lit(f"{draw.seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *hashes)

    def make():
        def step(batch):
            texts = batch.column(1).to_pylist()
            h = list(zip(*(batch.column(k).to_pylist() for k in range(2, 6))))
            for a, b in pieces(len(texts), [len(t) for t in texts], BATCH_CHARS):
                n, form, prefix, middle, output = zip(*(cut(t, x, draw) for t, x in zip(texts[a:b], h[a:b])))
                yield {"doc_id": batch.column(0).slice(a, b - a), "n": n, "form": form,
                       "prefix_chars": prefix, "middle_chars": middle, "output": output}
        return step

    return map_rows(rows, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string", make)


def restore(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone. The three marks stand in it once each."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # before the first mark: nothing
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)


def digests(docs: DataFrame, draw: Draw = Draw()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of the transformed documents."""
    return (transform(docs, draw)
            .withColumn("restored", restore(F.col("output"), F.col("form")))
            .select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                    F.sha2("restored", 256).alias("restored_sha256")))


def oracle_sql(draw: Draw = Draw()) -> str:
    """DuckDB SQL of ``digests``: lines as a list, cut by list positions."""
    def h(k: int) -> str:
        return f"('0x' || substr(digest, {8 * k + 1}, 8))::BIGINT"
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256('{draw.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units
  FROM documents),
ranks AS (
  SELECT *, len(units) AS n, {h(0)} % (len(units) + 1) AS r1, {h(1)} % (len(units) + 1) AS r2,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                   OR {h(2)} % 100 >= {draw.rate} THEN 'plain'
              WHEN {h(3)} % 100 < {draw.spm} THEN 'spm' ELSE 'psm' END AS form
  FROM docs),
parts AS (
  SELECT *, array_to_string(units[1:least(r1, r2)], '') AS p,
         array_to_string(units[least(r1, r2) + 1:greatest(r1, r2)], '') AS m,
         array_to_string(units[greatest(r1, r2) + 1:], '') AS s
  FROM ranks)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""
