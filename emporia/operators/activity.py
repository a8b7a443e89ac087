"""Query-log and activity jobs (keys I1-I8).

The reference reads these from server views; here they are jobs over log
and event tables: time windows (``F.window``), conditional aggregates, exact
distinct counts and mergeable sketches of them (``approx_count_distinct`` in
the streaming forms, see ``streaming.jobs``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.functions.windows import running_sum
from emporia.operators.common import top_k

WRITE_OPS = ("insert", "update", "delete")

# The tokens of a statement, tried in this order at each place. Every repeat is possessive: one pass, no
# backtracking, and no recursion in the matcher however long a string, comment or list is.
def _block_comment(depth: int) -> str:
    """A block comment with others nested in it, so many deep; an open one runs to the end."""
    inner = rf"/(?!\*)|{_block_comment(depth - 1)}" if depth > 1 else "/"
    return rf"/\*[^/*]*+(?:(?:\*(?!/)|{inner})[^/*]*+)*+(?:\*/|\z)"


COMMENT_DEPTH = 4
GAP = rf"(?:\s|--[^\n]*+|{_block_comment(COMMENT_DEPTH)})++"
ESCAPED = r"[eE]'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+(?:'|\\?\z)"
QUOTED = r"(?:[uU]&|[bBxXnN])?'[^']*+(?:''[^']*+)*+(?:'|\z)"
DOLLAR = r"\$(?<tag>(?:[\p{L}_][\p{L}\p{N}_]*+)?)\$.*?(?:\$\k<tag>\$|\z)"
NUMBER = r"0[xX][0-9a-fA-F]++|(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?"
NAME = r"\"[^\"]*+(?:\"\"[^\"]*+)*+(?:\"|\z)|[\p{L}_][\p{L}\p{N}_$]*+"
TOKEN = rf"(?s){GAP}|{ESCAPED}|{QUOTED}|{DOLLAR}|{NUMBER}|\$[0-9]++|{NAME}|."
IS_GAP = r"^(?:\s|--|/\*)"
IS_NUMBER = r"^\.?[0-9]"
IS_LITERAL = r"^(?:\.?[0-9]|(?:[uU]&|[bBxXnNeE])?'|\$(?:[\p{L}_][\p{L}\p{N}_]*+)?\$)"
# What a value stands before: a minus after one of these, or after a name that is no such word, subtracts.
ENDS_VALUE = r"""^(?:[)\]'"]|\$|\.?[0-9]|[\p{L}_])"""
# Words after which an expression begins, so a minus after them is a sign.
SIGN_WORDS = ("select", "distinct", "all", "where", "and", "or", "not", "in", "between", "like", "ilike", "is", "when", "then",
              "else", "case", "on", "having", "by", "limit", "offset", "set", "values", "return", "returning", "from", "using")
# Stands for a literal until all of a statement's literals are known; no statement holds it outside quotes.
MARK = "\u0001"
# Simple statements (strings and plain numbers only), for the SQL twin.
LITERAL_PATTERN = r"'(?:[^']|'')*'|\b\d+(?:\.\d+)?\b"


def normalise_query_col(q: str | Column) -> Column:
    """The statement as the statistics view groups it.

    Literals become $1, $2, ... in order of appearance, after the highest $n the
    statement has itself. A lexer finds them: strings with doubled quotes,
    escape strings, prefixed and dollar-quoted strings, numbers with fractions
    and exponents, hexadecimal ones; a minus before a number belongs to it unless it
    subtracts. Digits in names, quoted names and comments are no literals. An
    ``IN`` list of literals has one placeholder, whatever its length. Comments
    and blanks become one blank; at the ends they go. NULL stays NULL; an open
    string or comment runs to the end.
    """
    tokens = F.regexp_extract_all(S.col(q), F.lit(TOKEN), F.lit(0))
    # Runs of gaps are one token, so the token before a gap is what it follows.
    before = lambda ts, i: F.when(F.get(ts, i - 1).rlike(IS_GAP), F.get(ts, i - 2)).otherwise(F.get(ts, i - 1))
    after = lambda ts, i: F.when(F.get(ts, i + 1).rlike(IS_GAP), F.get(ts, i + 2)).otherwise(F.get(ts, i + 1))

    def signs(ts: Column) -> Column:
        """Minus signs that belong to a number, marked for removal with the blank behind them."""
        def is_sign(t: Column, i: Column) -> Column:
            prev = before(ts, i)
            value = prev.rlike(ENDS_VALUE) & ~F.lower(prev).isin(*SIGN_WORDS)
            return (t == "-") & F.coalesce(after(ts, i).rlike(IS_NUMBER), F.lit(False)) & ~F.coalesce(value, F.lit(False))
        return F.transform(ts, lambda t, i: F.when(is_sign(t, i), F.lit("")).otherwise(t))

    def shown(ts: Column) -> Column:
        return F.array_join(F.transform(ts, lambda t, i: (
            F.when(t.rlike(IS_GAP), F.when(F.get(ts, i - 1) == "", F.lit("")).otherwise(F.lit(" ")))
            .when(t.rlike(IS_LITERAL), F.lit(MARK)).otherwise(t))), "")

    # Each step sees the whole array of the one before, computed once.
    once = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    def own(ts: Column) -> Column:
        """The highest $n that the statement has itself."""
        found = F.transform(F.filter(ts, lambda t: t.rlike(r"^\$[0-9]+$")), lambda t: F.substring(t, 2, 9).cast("long"))
        return F.coalesce(F.array_max(found), F.lit(0))

    def numbered(x: Column) -> Column:
        parts, first = x["parts"], x["first"]
        return F.concat(F.array_join(F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p, i: F.concat(
            p, F.lit("$"), (first + i + 1).cast("string"))), ""), F.element_at(parts, F.size(parts)))

    def statement(ts: Column) -> Column:
        text = F.trim(F.regexp_replace(once(signs(ts), shown), rf"(?i)\b(IN) ?\( ?{MARK}(?: ?, ?{MARK})*+ ?\)", rf"$1 ({MARK})"))
        return once(F.struct(F.split(text, MARK, -1).alias("parts"), own(ts).alias("first")), numbered)

    return once(tokens, statement)


def normalise_query_sql(q: str) -> str:
    """DuckDB twin for statements whose literals are plain strings and unsigned numbers."""
    pat = LITERAL_PATTERN.replace("'", "''")
    parts = f"regexp_split_to_array({q}, '{pat}')"
    return (f"(array_to_string(list_transform(list_slice({parts}, 1, len({parts}) - 1), "
            f"lambda x, i: x || '$' || CAST(i AS VARCHAR)), '') || {parts}[len({parts})])")


def normalise_query(log: DataFrame, col: str = "query", out: str = "normalized_query") -> DataFrame:
    """I2 as a frame transform."""
    return log.withColumn(out, normalise_query_col(col))


def slowest_queries(log: DataFrame, n: int = 20) -> DataFrame:
    """Per normalised query: calls, total and mean time, total/calls; top n by mean.

    Times are kept in exact decimals (ms with 2 decimals), mean rounded half
    up to 3 decimals, so the result does not depend on summation order.
    """
    d = log.withColumn("normalized_query", normalise_query_col("query")) \
        .withColumn("_ms", F.col("duration_ms").cast("decimal(18,2)"))
    g = d.groupBy("normalized_query").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("_ms").cast("decimal(38,2)").alias("total_exec_time"),
        S.avg_round("_ms", 3, 2).alias("mean_exec_time"))
    g = g.withColumn("avg_time_ms", S.half_up_div_wide((F.col("total_exec_time") * 100), F.col("calls") * 100, 3)
                     .cast("decimal(18,3)"))
    return top_k(g, n, F.col("mean_exec_time").desc_nulls_first(), F.col("normalized_query").asc())


def _win(ts: str, width: str, slide: str | None = None) -> Column:
    return F.window(ts, width, slide) if slide else F.window(ts, width)


def row_activity(log: DataFrame, width: str = "5 minutes", ts: str = "ts") -> DataFrame:
    """Inserts / updates / deletes per time window."""
    op = F.col("operation")
    return (log.groupBy(_win(ts, width).alias("w"))
            .agg(F.count(F.when(op == "insert", 1)).alias("inserts"),
                 F.count(F.when(op == "update", 1)).alias("updates"),
                 F.count(F.when(op == "delete", 1)).alias("deletes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "inserts", "updates", "deletes"))


_UNIT_SECONDS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
                 "day": 86400, "days": 86400}


def _seconds(width: str) -> int:
    n, unit = width.split()
    return int(n) * _UNIT_SECONDS[unit]


def _panes(widths, slide: str) -> dict[str, int]:
    """How many slides each width spans."""
    step = _seconds(slide)
    for w in widths:
        if _seconds(w) % step:
            raise ValueError("each width must be a multiple of the slide")
    return {w: _seconds(w) // step for w in widths}


def working_set(log: DataFrame, widths=("5 minutes", "15 minutes", "1 hour"), slide: str = "5 minutes",
                item: str = "user_id", ts: str = "ts") -> DataFrame:
    """I4: distinct items touched in the last ``width``, every ``slide``; exact.

    Same windows as ``F.window(ts, width, slide)``, without copying an item into
    each of them. Of an item's panes (slides it was seen in), one adds to the
    windows from its own place back over the width, as far as the pane before
    has not covered them: one interval, that is +1 at its start and -1 behind its
    end. The steps of all items are summed per place (partial aggregation), a
    running sum over the places gives the counts, and places without a step
    repeat the count before them. What is shuffled is one row for each distinct
    (pane, item); NULL items are not counted.
    """
    panes, step = _panes(widths, slide), _seconds(slide)
    # Places are counted from the epoch of the column's own type, so no session time zone is involved.
    ntz = log.schema[ts].dataType.typeName() == "timestamp_ntz"
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") if ntz else F.timestamp_seconds(F.lit(0))
    n = F.timestamp_diff("SECOND", epoch, F.window(ts, slide).start)
    seen = (log.filter(F.col(item).isNotNull()).select((n / step).cast("long").alias("_n"), F.col(item).alias("_item")).distinct()
            .withColumn("_before", F.lag("_n").over(Window.partitionBy("_item").orderBy("_n"))))
    steps = F.explode(F.array(*[x for w, k in panes.items() for x in (
        F.struct(F.lit(w).alias("width"), F.greatest(F.col("_n") - (k - 1), F.coalesce(F.col("_before") + 1, F.col("_n") - (k - 1)))
                 .alias("at"), F.lit(1).alias("d")),
        F.struct(F.lit(w).alias("width"), (F.col("_n") + 1).alias("at"), F.lit(-1).alias("d")))]))
    per_place = seen.select(steps.alias("s")).groupBy("s.width", "s.at").agg(F.sum("s.d").alias("d")).filter("d <> 0")
    counts = running_sum(per_place, ["width"], ["at"], {"items": F.col("d")})
    # One row a place and width is left; the next place bounds the stretch with this count.
    until = F.lead("at").over(Window.partitionBy("width").orderBy("at"))
    stretches = counts.withColumn("_until", until).filter("items > 0")
    secs = F.element_at(F.create_map(*[x for w in panes for x in (F.lit(w), F.lit(_seconds(w)))]), F.col("width"))
    start = epoch + F.make_dt_interval(secs=F.col("_at") * step)
    return (stretches.select("width", "items", F.explode(F.sequence("at", F.col("_until") - 1)).alias("_at"))
            .select("width", start.alias("window_start"), (start + F.make_dt_interval(secs=secs)).alias("window_end"), "items"))


def pane_sketches(log: DataFrame, slide: str = "5 minutes", item: str = "user_id", ts: str = "ts", lg_k: int = 12) -> DataFrame:
    """(pane, sketch): a HyperLogLog sketch of each pane's items, about 2^lg_k bytes at most.

    Sketches merge, so they can be kept: a day's panes are written once and
    every window over them is a union, without reading the log again.
    """
    return (log.groupBy(F.window(ts, slide).start.alias("pane"))
            .agg(F.hll_sketch_agg(item, lg_k).alias("sketch")))


def working_set_sketch(panes: DataFrame, widths=("5 minutes", "15 minutes", "1 hour"), slide: str = "5 minutes") -> DataFrame:
    """I4 from ``pane_sketches``: estimates for the windows of ``working_set``.

    Only panes, one row a slide, are placed into the windows over them; items
    are not. The relative standard error is about 1.04 / sqrt(2^lg_k) (1.6 % at
    12); sets below 2^(lg_k - 3) items are counted exactly.
    """
    fan = F.explode(F.array(*[F.struct(F.lit(w).alias("width"), F.lit(_seconds(w)).alias("secs"), F.lit(i * _seconds(slide)).alias("back"))
                              for w, k in _panes(widths, slide).items() for i in range(k)])).alias("f")
    start = F.col("pane") - F.make_dt_interval(secs=F.col("f.back"))
    return (panes.select("pane", "sketch", fan)
            .groupBy(F.col("f.width").alias("width"), start.alias("window_start"),
                     (start + F.make_dt_interval(secs=F.col("f.secs"))).alias("window_end"))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("items")).filter("items > 0"))


def cache_hit_rate(log: DataFrame, width: str = "1 hour", target: float = 0.99, ts: str = "ts") -> DataFrame:
    """Hits / reads per window and whether it is below the target."""
    g = log.filter(F.col("cache_hit").isNotNull()).groupBy(_win(ts, width).alias("w")).agg(
        F.count(F.lit(1)).alias("reads"), F.count(F.when(F.col("cache_hit"), 1)).alias("hits"))
    rate = S.half_up_div(F.col("hits"), F.col("reads"), 4).cast("decimal(10,4)")
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "reads", "hits",
                    rate.alias("hit_rate"), (rate < F.lit(target)).alias("below_target"))


def failed_operations(log: DataFrame) -> DataFrame:
    """Operations with status Error, slowest first."""
    return (log.filter(F.col("status") == "Error")
            .select("query_id", "ts", "operation", "query", "duration_ms")
            .orderBy(F.col("duration_ms").desc(), F.col("query_id")))


def connection_usage(log: DataFrame, width: str = "1 hour", max_connections: int = 100,
                     ts: str = "ts", user: str = "user_id") -> DataFrame:
    """Active (wrote something), idle and total sessions per window, vs the maximum.

    Two-phase: one row per (window, user) with "did it write", then counts
    per window -- no multi-distinct expansion.
    """
    wrote = F.max(F.col("operation").isin(*WRITE_OPS).cast("int"))
    per_user = log.groupBy(_win(ts, width).alias("w"), F.col(user)).agg(wrote.alias("_active"))
    g = per_user.groupBy("w").agg(F.count(F.lit(1)).alias("total"), F.sum("_active").cast("long").alias("active"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "active", (F.col("total") - F.col("active")).alias("idle"), "total",
                    F.lit(max_connections).alias("max_connections"),
                    S.half_up_div(F.col("total"), F.lit(max_connections), 4).cast("decimal(10,4)").alias("utilization"))


def replication_lag(commits: DataFrame, applies: DataFrame) -> DataFrame:
    """I8: per version the commit time, the last apply time and the gap in seconds.

    ``commits``: (version, committed_at) rows; ``applies``: (version,
    applied_at) rows, one per applied change. Both are reduced to one row per
    version before the join.
    """
    c = commits.groupBy("version").agg(F.max("committed_at").alias("committed_at"))
    a = applies.groupBy("version").agg(F.max("applied_at").alias("applied_at"),
                                       F.count(F.lit(1)).alias("applied_rows"))
    j = c.join(a, "version")
    # Wall-clock difference of the two times (no session time zone involved).
    lag = F.timestamp_diff("SECOND", F.col("committed_at"), F.col("applied_at"))
    return j.select("version", "committed_at", "applied_at", "applied_rows",
                    lag.cast("long").alias("lag_seconds"))
