"""Activity jobs: the statement lexer, windows of distinct items, and the live replication lag."""

import random
import time
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emporia.operators import activity as A
from emporia.operators import versions as V
from emporia.streaming.jobs import replication_lag_stream

T0 = datetime(2024, 1, 1)


# --- I2: a lexer that walks character by character --------------------------------

def name_char(c):
    return c.isalpha() or c == "_" or c.isnumeric()


def lex(s):
    """[(kind, text)]; kinds: gap, literal, number, param, name, quoted, other."""
    out, i, n = [], 0, len(s)

    def upto(j, kind):
        nonlocal i
        out.append((kind, s[i:j]))
        i = j

    def quoted(j, q, escapes=False):
        while j < n:
            if escapes and s[j] == "\\":
                j += 2
            elif s[j] == q:
                if s[j + 1:j + 2] != q:
                    return j + 1
                j += 2
            else:
                j += 1
        return n

    while i < n:
        c, d = s[i], s[i:i + 2]
        if c.isspace():
            upto(i + 1, "gap")
        elif d == "--":
            j = s.find("\n", i)
            upto(n if j < 0 else j, "gap")
        elif d == "/*":
            depth, j = 1, i + 2
            while j < n and depth:
                if s[j:j + 2] == "/*" and depth < A.COMMENT_DEPTH:
                    depth, j = depth + 1, j + 2
                elif s[j:j + 2] == "*/":
                    depth, j = depth - 1, j + 2
                else:
                    j += 1
            upto(j, "gap")
        elif c in "eE" and s[i + 1:i + 2] == "'":
            upto(quoted(i + 2, "'", True), "literal")
        elif c in "bBxXnN" and s[i + 1:i + 2] == "'":
            upto(quoted(i + 2, "'"), "literal")
        elif d in ("u&", "U&") and s[i + 2:i + 3] == "'":
            upto(quoted(i + 3, "'"), "literal")
        elif c == "'":
            upto(quoted(i + 1, "'"), "literal")
        elif c == '"':
            upto(quoted(i + 1, '"'), "quoted")
        elif c == "$":
            j = i + 1
            if j < n and (s[j].isalpha() or s[j] == "_"):
                while j < n and name_char(s[j]):
                    j += 1
            if s[j:j + 1] == "$":
                tag = s[i:j + 1]
                k = s.find(tag, j + 1)
                upto(n if k < 0 else k + len(tag), "literal")
            elif s[i + 1:i + 2].isdigit():
                j = i + 1
                while j < n and s[j].isdigit():
                    j += 1
                upto(j, "param")
            else:
                upto(i + 1, "other")
        elif c.isdigit() or (c == "." and s[i + 1:i + 2].isdigit()):
            j = i
            if d in ("0x", "0X") and s[i + 2:i + 3] and s[i + 2] in "0123456789abcdefABCDEF":
                j = i + 2
                while j < n and s[j] in "0123456789abcdefABCDEF":
                    j += 1
            else:
                while j < n and s[j].isdigit():
                    j += 1
                if s[j:j + 1] == ".":
                    j += 1
                    while j < n and s[j].isdigit():
                        j += 1
                k = j
                if s[k:k + 1] in ("e", "E") and k < n:
                    k += 1
                    if s[k:k + 1] in ("+", "-") and k < n:
                        k += 1
                    if s[k:k + 1].isdigit():
                        while k < n and s[k].isdigit():
                            k += 1
                        j = k
            upto(j, "number")
        elif c.isalpha() or c == "_":
            j = i
            while j < n and (name_char(s[j]) or s[j] == "$"):
                j += 1
            upto(j, "name")
        else:
            upto(i + 1, "other")
    return out


def normalised(s):
    merged = []
    for kind, text in lex(s):
        if kind == "gap" and merged and merged[-1][0] == "gap":
            continue
        merged.append((kind, " " if kind == "gap" else text))
    solid = [k for k, t in enumerate(merged) if t[0] != "gap"]
    gone = set()
    for at, k in enumerate(solid):
        if merged[k] == ("other", "-") and at + 1 < len(solid) and merged[solid[at + 1]][0] == "number":
            kind, text = merged[solid[at - 1]] if at else ("start", "")
            subtracts = kind in ("literal", "number", "param", "quoted") or (kind == "name" and text.lower() not in A.SIGN_WORDS) \
                or text in (")", "]") or text == "$"
            if not subtracts:
                gone.add(k)
                if merged[k + 1][0] == "gap":
                    gone.add(k + 1)
    toks = [("lit" if t[0] in ("literal", "number") else t[0], t[1]) for k, t in enumerate(merged) if k not in gone]
    out, k = [], 0
    while k < len(toks):  # IN lists of literals
        out.append(toks[k])
        if toks[k][0] == "name" and toks[k][1].lower() == "in":
            j = k + 1
            skip = lambda j: j + 1 if j < len(toks) and toks[j][0] == "gap" else j
            j = skip(j)
            if j < len(toks) and toks[j] == ("other", "("):
                j = skip(j + 1)
                ok = j < len(toks) and toks[j][0] == "lit"
                j += 1
                while ok and (m := skip(j)) < len(toks) and toks[m] == ("other", ","):
                    m = skip(m + 1)
                    if not (m < len(toks) and toks[m][0] == "lit"):
                        ok = False
                    j = m + 1
                j = skip(j)
                if ok and j < len(toks) and toks[j] == ("other", ")"):
                    out += [("gap", " "), ("other", "("), ("lit", ""), ("other", ")")]
                    k = j
        k += 1
    first = max([int(t[1][1:][:9]) for t in toks if t[0] == "param"], default=0)
    text, i = "", 0
    for kind, t in out:
        if kind == "lit":
            i += 1
            t = f"${first + i}"
        text += t
    return text.strip(" ")


STATEMENTS = [
    "SELECT * FROM t1 WHERE a = 'it''s' AND b=-5 AND c IN (1, 2,3) AND d - 5 > 1.5e-3 -- tail 7\n", "a IN (1+2, 3)", "in (-1, - 2,'x')",
    "select E'a\\'b', $$x ' 1$$, $t$ $$ 2 $t$, b'01', U&'x' /* 5 /* nested 'q */ 3 */ , \"col 1\" , $3, x-1, (-1), - 2, .5, 0xFF, 1.",
    "", "  ", "'open", "/* open 1", "IN (1, b)", "a -- c\n\n/*x*/ b", "a$1$b", "é1 = 2", "f(1)-2, a[3]-4, 'x'-1", "limit -1", "E'x\\", "$", "0x", "1e",
]
PIECES = st.sampled_from(["'", "''", '"', "$", "$a$", "$$", "--", "\n", "/*", "*/", "\\", "E'", "x'", "in", " IN ", "(", ")", ",", " ", "-", "1", "2.5",
                          "1e", "e-3", ".", "0x", "a", "select", "t1", "$7", "]", "=", "é"])


def test_statements_equal_a_lexer_by_characters(spark):
    got = {r.query: r.normalized_query for r in A.normalise_query(spark.createDataFrame([(q,) for q in STATEMENTS + [None]], "query string")).collect()}
    assert got.pop(None) is None
    assert got == {q: normalised(q) for q in STATEMENTS}
    assert got[STATEMENTS[0]] == "SELECT * FROM t1 WHERE a = $1 AND b=$2 AND c IN ($3) AND d - $4 > $5"


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=60, max_size=120, unique=True))
def test_random_statements_equal_a_lexer_by_characters(spark, queries):
    rows = A.normalise_query(spark.createDataFrame([(q,) for q in queries], "query string")).collect()
    assert {r.query: r.normalized_query for r in rows} == {q: normalised(q) for q in queries}


def test_long_statements_take_linear_time(spark):
    n = 200_000
    long = ["'" + "''" * n + "'", "in (" + ",".join(["1"] * n) + ")", "--\n" * n, "/*" * n, "a-" * n, "$a$" * n, "E'" + "\\'" * n, "((" * n, "/*x*/" * n]
    begin = time.monotonic()
    got = A.normalise_query(spark.createDataFrame([(q,) for q in long], "query string")).collect()
    assert time.monotonic() - begin < 60 and got[0].normalized_query == "$1" and got[1].normalized_query == "in ($1)"


def test_slowest_queries_group_lists_comments_and_signs(spark):
    log = spark.createDataFrame([("select 1 where a in (1,2)", 2.0), ("select -7 where a in (3) -- x", 4.0), ("select  2 where a in (1, 2, 3)", 6.0),
                                 ("select a - 1", 1.0)], "query string, duration_ms double")
    got = {r.normalized_query: (r.calls, float(r.mean_exec_time)) for r in A.slowest_queries(log).collect()}
    assert got == {"select $1 where a in ($2)": (3, 4.0), "select a - $1": (1, 1.0)}


# --- I4 ------------------------------------------------------------------------------

def windows(rows, widths=((1, "5 minutes"), (3, "15 minutes"), (12, "1 hour"))):
    seen = {}
    for user, at in rows:
        if user is not None:
            p = int((at - T0).total_seconds()) // 300
            for k, w in widths:
                for i in range(k):
                    seen.setdefault((w, T0 + timedelta(minutes=5 * (p - i))), set()).add(user)
    return {k: len(v) for k, v in seen.items()}


@pytest.mark.parametrize("seed", range(3))
def test_working_set_equals_sets_and_its_sketches(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 1, 1, 1, *range(40)]), T0 + timedelta(seconds=rng.choice([rng.randrange(86400), rng.randrange(7200)]))) for _ in range(3000)]
    log = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz")
    for out in (A.working_set(log), A.working_set_sketch(A.pane_sketches(log))):
        got = {(r.width, r.window_start): r.items for r in out.collect()}
        assert got == windows(rows) and len(got) == out.count()
    assert A.working_set(log.limit(0)).count() == 0
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:  # wall times, whatever the session's zone
        assert {(r.width, r.window_start): r.items for r in A.working_set(log).collect()} == windows(rows)
        at = log.withColumn("ts", F.col("ts").cast("timestamp"))
        assert A.working_set(at).schema["window_start"].dataType.typeName() == "timestamp"
        assert sorted(r.items for r in A.working_set(at).collect()) == sorted(windows(rows).values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sketches_stay_within_their_error_and_copy_no_item(spark):
    n = 60_000
    log = spark.range(n).select(F.col("id").alias("user_id"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") % 3600)).alias("ts"))
    exact = {(r.width, r.window_start): r.items for r in A.working_set(log).collect()}
    out = A.working_set_sketch(A.pane_sketches(log))
    near = {(r.width, r.window_start): r.items for r in out.collect()}
    assert near.keys() == exact.keys()
    assert all(abs(near[k] - exact[k]) <= 0.065 * exact[k] for k in exact)  # four standard errors
    assert exact[("1 hour", T0)] == n
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The fan into windows stands above the sketches' aggregate, that is on panes.
    assert plan.index("Generate") < plan.index("hll_sketch_agg")
    fan = A.working_set(log)._jdf.queryExecution().optimizedPlan().toString()
    assert "count(distinct" not in fan


# --- I8 ------------------------------------------------------------------------------

def test_lag_stream_equals_batch_with_late_and_missing_applies(spark, scratch):
    minute = lambda m: T0 + timedelta(minutes=m)
    commits = [(v, minute(5 * v)) for v in range(40)]
    applies = [(v, minute(5 * v) + timedelta(seconds=s)) for v in range(40) if v % 7 for s in (10, 20 + v)]
    applies += [(3, minute(15) + timedelta(minutes=45)), (8, minute(40) + timedelta(minutes=90))]  # within the bound, and beyond it
    c_schema, a_schema = "version long, committed_at timestamp_ntz", "version long, applied_at timestamp_ntz"
    mark = [(10_000, minute(10_000))]  # moves both watermarks past everything
    for k in range(4):
        spark.createDataFrame(commits[k::4], c_schema).coalesce(1).write.parquet(f"{scratch}/c/{k}")
        spark.createDataFrame(applies[k::4], a_schema).coalesce(1).write.parquet(f"{scratch}/a/{k}")
    late = 12 * 60  # all of one batch may be this late
    c = spark.readStream.schema(c_schema).parquet(f"{scratch}/c/*")
    a = spark.readStream.schema(a_schema).parquet(f"{scratch}/a/*")

    def run():
        q = (replication_lag_stream(c, a, "1 hour", f"{late} minutes").writeStream.format("parquet").option("path", f"{scratch}/out")
             .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        return q
    run()
    spark.createDataFrame(mark, c_schema).coalesce(1).write.parquet(f"{scratch}/c/end")
    spark.createDataFrame(mark, a_schema).coalesce(1).write.parquet(f"{scratch}/a/end")
    q = run()
    got = {r.version: (r.applied_at.replace(tzinfo=None) if r.applied_at else None, r.applied_rows, r.lag_seconds)
           for r in spark.read.parquet(f"{scratch}/out").collect()}
    in_bound = [(v, at) for v, at in applies if at - dict(commits)[v] <= timedelta(hours=1)]
    batch = A.replication_lag(spark.createDataFrame(commits, c_schema), spark.createDataFrame(in_bound, a_schema)).collect()
    want = {r.version: (r.applied_at, r.applied_rows, r.lag_seconds) for r in batch}
    want |= {v: (None, 0, None) for v, _ in commits if v % 7 == 0}
    assert got == want
    # What the bound and the lateness have passed is no longer held.
    held = {s["operatorName"]: s["numRowsTotal"] for s in q.lastProgress["stateOperators"]}
    assert sum(held.values()) <= 4, held


# --- G5 ------------------------------------------------------------------------------

def test_profile_is_one_pass_of_sketches(spark):
    df = spark.range(20_000).selectExpr("id AS a", "id % 7 AS b", "IF(id % 2 = 0, NULL, 'x') AS c", "map('k', id % 3) AS m", "array(id % 5) AS l",
                                        "named_struct('s', id % 4) AS s", "CAST(NULL AS INT) AS n")
    got = {r.column_name: (r.null_count, r.distinct_count) for r in V.column_profile(df, df.columns).collect()}
    assert {k: v for k, v in got.items() if k != "a"} == {"b": (0, 7), "c": (10_000, 1), "m": (0, 3), "l": (0, 5), "s": (0, 4), "n": (20_000, 0)}
    assert got["a"][0] == 0 and abs(got["a"][1] - 20_000) < 20_000 * 0.065
    plan = V.column_profile(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    exact = {r.column_name: r.distinct_count for r in V.column_profile(df, ["a", "b", "m"], exact=True).collect()}
    assert exact == {"a": 20_000, "b": 7, "m": 3}


@pytest.mark.parametrize("version", [60, 72])
def test_changed_ratio_of_a_feed_equals_the_built_state(spark, sf_dir, version):
    from emporia.operators import sync as Y
    from emporia.sources.tables import Tables
    feed = Tables(spark, sf_dir).order_changes
    state = V.state_at_version(feed, ["id"], version)
    assert Y.changed_ratio_of_feed(feed, ["id"], version).collect() == Y.changed_ratio(feed, state, ["id"], version).collect()
