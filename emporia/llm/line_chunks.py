"""Line dedup over content-defined chunks of lines, in DataFrame functions only.

A text is cut at its line feeds, and every line is hashed. A window of two
lines (the next line that is not blank after each one, with the blank lines
between) rolls over the line hashes, so each place of a text has one. A window that stands at
an earlier place too, in another document or further up, is *repeated*. A chunk
is a maximal run of lines under repeated windows: it begins and ends where the
text begins and ends to differ from what was seen before, whatever stands
around it, so text put in elsewhere moves no boundary, and a passage of two lines
or more is found whole between any neighbours. A paragraph kept on one line
(``LONG_LINE_WORDS`` words or more) is a window by itself; other single lines
are none.

The lines of repeated chunks are removed; the first occurrence of each window, by
doc_id and then by place, stays. Every line that goes stands at an
earlier place in the same company, so no content is lost.

Windows are grouped by the hashes of both lines and of what is between. That
equal hashes mean equal bytes is checked on the lines themselves: of each hash the
smallest and the largest line are compared, and a hash that stands for two
lines removes nothing.

Scale: what is shuffled for the windows is short rows of numbers, partially
aggregated, so a window that a third of all documents share is one row for each
task. The joins back are equi-joins on the hashes which the adaptive skew join
can split. Lines move once by hash, one smallest and one largest for each task, and whole
texts once in the documents' final join.

Defined results: a null text stays null with no lines; an empty text is one
empty line. A document whose lines were all removed has an empty text. Rows with the same
doc_id and text are treated alike (they are one document, so neither copy
removes the other); rows with the same doc_id and different texts are two
documents, in the order of a hash of their texts. A null doc_id sorts first. Very long texts are
cut whole, in time and memory in proportion to them. Extra columns are not read here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import written

LONG_LINE_WORDS = 50
BLANK = " \r\t"


def _is_long(line: Column, words: int) -> Column:
    """Whether a line has that many words: blanks counted in bytes, which needs no decoding."""
    blanks = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return (F.octet_length(line) >= words) & (blanks >= words - 1)


def window_rows(docs: DataFrame, long_line_words: int | None = LONG_LINE_WORDS) -> DataFrame:
    """(doc_id, text) -> one row for each window: doc_id, th, start, stop (lines, from 0, both included), a, b, between.

    ``a`` and ``b`` are the hashes of the first and the last line, ``between`` that of
    the blank lines in the middle (0: there are none). th is a hash of the whole text.
    """
    at = lambda array, i: F.element_at(array, (i + 1).cast("int"))
    lines = (docs.filter(F.col("text").isNotNull())
             .select("doc_id", F.xxhash64("text").alias("th"), F.split("text", "\n", -1).alias("lines")))
    solid = (lines.withColumn("h", F.transform("lines", lambda x: F.xxhash64(x)))
             .withColumn("solid", F.filter(F.sequence(F.lit(0), F.size("lines") - 1),
                                           lambda i: F.btrim(at(F.col("lines"), i), F.lit(BLANK)) != "")))

    def window(i: Column, j: Column) -> Column:
        middle = F.when(j - i > 1, F.xxhash64(F.slice("h", i + 2, j - i - 1))).otherwise(F.lit(0).cast("long"))
        return F.struct(i.alias("start"), j.alias("stop"), at(F.col("h"), i).alias("a"), at(F.col("h"), j).alias("b"), middle.alias("between"))

    pairs = F.transform(F.slice("solid", F.lit(1), F.greatest(F.size("solid") - 1, F.lit(0))),
                        lambda i, k: window(i, F.element_at("solid", k + 2)))
    if long_line_words:
        alone = F.transform(F.filter("solid", lambda i: _is_long(at(F.col("lines"), i), long_line_words)), lambda i: window(i, i))
        pairs = F.concat(pairs, alone)
    return solid.select("doc_id", "th", F.inline(pairs))


def ambiguous_hashes(docs: DataFrame) -> DataFrame:
    """(h) of hashes that stand for lines of different bytes (normally none)."""
    lines = docs.filter(F.col("text").isNotNull()).select(F.explode(F.split("text", "\n", -1)).alias("line"))
    return (lines.groupBy(F.xxhash64("line").alias("h")).agg(F.min("line").alias("lo"), F.max("line").alias("hi"))
            .filter("lo <> hi").select("h"))


def repeated_windows(docs: DataFrame, long_line_words: int | None = LONG_LINE_WORDS) -> DataFrame:
    """doc_id, th, start, stop of every window that stands at an earlier place too."""
    windows = window_rows(docs, long_line_words).withColumn("lone", F.col("start") == F.col("stop"))
    key = ["a", "b", "between", "lone"]
    again = windows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)
    found = written(windows.join(again, key, "left_semi"), "windows")
    place = F.struct("doc_id", "th", "start")
    first = found.groupBy(*key).agg(F.min(place).alias("first"))
    doubtful = written(ambiguous_hashes(docs), "ambiguous")
    return (found.join(first, key).filter(~place.eqNullSafe(F.col("first")))
            .join(doubtful.withColumnRenamed("h", "a"), "a", "left_anti").join(doubtful.withColumnRenamed("h", "b"), "b", "left_anti")
            .select("doc_id", "th", "start", "stop"))


def _deduped(docs: DataFrame, id_col: str, text_col: str, long_line_words: int | None) -> DataFrame:
    """own (struct of the row's other columns), doc_id, text, n_lines, n_removed."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    base = docs.select(F.struct(*others, F.lit(1).alias("_")).alias("own"),
                       F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    gone = (repeated_windows(base.select("doc_id", "text"), long_line_words)
            .groupBy(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th"))
            .agg(F.collect_set(F.struct("start", "stop")).alias("gone")))  # at most one document's windows
    joined = base.withColumn("th", F.xxhash64("text")).join(
        gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("th") == F.col("gone_th")), "left")
    lines = F.split("text", "\n", -1)
    # The numbers of the removed lines; array_except works with a hash set.
    removed = F.flatten(F.transform("gone", lambda c: F.sequence(c["start"], c["stop"])))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    # The one-element array binds the lines once for all of their numbers.
    text = F.element_at(F.transform(F.array(lines), lambda all_lines: F.array_join(
        F.transform(kept, lambda i: F.element_at(all_lines, i + 1)), "\n")), 1)
    n_removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept)).cast("long")
    return joined.select(
        "own", "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        n_removed.alias("n_removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                long_line_words: int | None = LONG_LINE_WORDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text without the repeated chunks, n_lines, n_removed (lines)."""
    return (_deduped(docs.select(id_col, text_col), id_col, text_col, long_line_words)
            .select("doc_id", "text", "n_lines", "n_removed"))


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
               long_line_words: int | None = LONG_LINE_WORDS) -> DataFrame:
    """The rows of ``docs`` with all their columns and the new text (and its length).

    Rows of which nothing but blanks is left go: all their lines stand at earlier places.
    """
    out = _deduped(docs, id_col, text_col, long_line_words)
    out = out.filter((F.col("n_removed") == 0) | (F.btrim("text", F.lit(BLANK + "\n")) != ""))
    length = F.when(F.col("n_removed") > 0, F.length("text"))
    return out.select(*[
        F.col("text").alias(c) if c == text_col
        else F.coalesce(length, F.col("own")[c]).cast(docs.schema[c].dataType).alias(c) if c == length_col
        else F.col("own")[c].alias(c) for c in docs.columns])


def oracle_sql(long_line_words: int = LONG_LINE_WORDS, source: str = "documents") -> str:
    """DuckDB SQL for ``dedup_lines`` over a table with unique doc_ids: windows compared as texts."""
    return f"""
WITH docs AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM {source} WHERE text IS NOT NULL),
split AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM docs),
solid AS (
  SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM split WHERE trim(line, ' ' || chr(13) || chr(9)) <> ''),
windows AS (
  SELECT s.doc_id, s.i AS start, s.j AS stop, array_to_string(d.lines[s.i + 1:s.j + 1], chr(10)) AS chunk
  FROM solid s JOIN docs d ON d.doc_id IS NOT DISTINCT FROM s.doc_id WHERE s.j IS NOT NULL
  UNION ALL
  SELECT doc_id, i, i, line FROM solid WHERE length(line) - length(replace(line, ' ', '')) >= {long_line_words - 1}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY start = stop, chunk ORDER BY doc_id, start) AS k FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS i FROM ranked WHERE k > 1),
kept AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.i) FILTER (g.i IS NULL) AS text,
         count(*) AS n_lines, count(g.i) AS n_removed
  FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM {source} d LEFT JOIN kept k ON d.doc_id = k.doc_id"""
