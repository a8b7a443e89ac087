"""URL filter: rules first, then trust and distrust propagated along links between hosts. DataFrame functions only.

Rules name a host and the start of a path; a rule fits its host and all
subdomains, the longest one wins. Where no rule fits, the host's place in the
link graph decides:

* seeds: a host is trusted by the share of its pages that a rule allows, and
  distrusted by the share that a rule blocks;
* trust is a personalised PageRank from the trusted seeds along the links: a
  host passes on ``DAMPING`` percent of its score, in equal parts, to the hosts
  it links to;
* distrust runs against the links, from the blocked seeds to the hosts that
  link to them, in equal parts to all hosts that do;
* a host is blocked if its distrust reaches ``BLOCK_AT`` and exceeds its trust.

Scores are whole numbers (``UNIT`` is a full seed) and every part is rounded
down, so sums do not depend on the order of rows and each round gives the same
numbers on every cluster. Both scores run in one table of flows. The rounds end
when no score changes any more, or after ``ROUNDS``; what the rounds after that
could move is below ``DAMPING`` percent to that power.

Links are the ``href`` of ``a`` and ``area`` tags of whole pages. A link with a
scheme or two leading slashes names its host; others stay on their host, which
is no edge. An edge counts once, however many pages hold the link, so a page
farm gains nothing.

Scale: pages are scanned once for links (each page's distinct hosts, then
distinct edges with partial aggregation) and once for urls alone. A round joins
one score a host to the edges and sums with partial aggregation; a hub's edges
can be split by the adaptive skew join, and no neighbourhood is gathered in a
row. Every round's scores are written to the shared folder. Pages meet the
scores of their host in a left join that can be split in the same way.

Defined results: a null url or one without ``://`` has an empty host and path:
no rule fits it, it is no node, and the method allows it, as every host without
scores. Empty hosts in links are skipped. A null page has no links. Repeated
rows count as pages of their own in the shares. Pages of any length are read whole, in
linear time. Of rules of equal length the one with the longer host
wins, then the blocking one. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import written

#: A full seed, the percentage passed on, and the distrust that blocks: half of what a wholly blocked host keeps by itself.
UNIT = 1_000_000_000
DAMPING = 85
BLOCK_AT = UNIT * (100 - DAMPING) // 200
ROUNDS = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host and path of a url, and the links of a page.
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
HREF = r"""(?i)<(?:a|area)[ \t\r\n\f/](?:[^<>]*?[ \t\r\n\f"'/])?href[ \t\r\n\f]*=[ \t\r\n\f]*("[^"<>]*"|'[^'<>]*'|[^ \t\r\n\f"'<>]+)"""
LINK = r"(?s)^[\"' \t\r\n\f]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#\"' \t\r\n\f]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The contract's rules.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/"))


def _ranked(rules) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block", r.text))


def _fits(r: Rule, host: Column, path: Column) -> Column:
    return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)


def _first(rules, host: Column, path: Column, value) -> Column:
    out = F.lit(None).cast("string")
    for r in reversed(_ranked(rules)):
        out = F.when(_fits(r, host, path), F.lit(value(r))).otherwise(out)
    return out


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def parsed(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, ruled): each url's parts and the rule that wins, with its verdict."""
    url = F.coalesce(F.col("url"), F.lit(""))
    return (pages.select(F.col("page_id").cast("long").alias("page_id"),
                         _lower(F.regexp_extract(url, URL, 1)).alias("host"), F.regexp_extract(url, URL, 2).alias("path"))
            .withColumn("rule", _first(rules, F.col("host"), F.col("path"), lambda r: r.text))
            .withColumn("ruled", _first(rules, F.col("host"), F.col("path"), lambda r: r.verdict)))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): distinct links between different hosts."""
    src = _lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), URL, 1))
    links = F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(HREF), F.lit(1))
    hosts = F.array_distinct(F.transform(links, lambda x: _lower(F.regexp_extract(x, LINK, 1))))
    return (pages.select(src.alias("src"), F.explode(hosts).alias("dst"))
            .filter("src <> '' AND dst <> '' AND src <> dst").distinct())


def seeds(judged: DataFrame) -> DataFrame:
    """(kind, node, seed): hosts with pages that a rule allows (``trust``) or blocks (``distrust``)."""
    n = F.count(F.lit(1))
    by_host = (judged.filter("host <> ''").groupBy(F.col("host").alias("node"))
               .agg(F.floor(F.count(F.when(F.col("ruled") == "allow", 1)) * UNIT / n).alias("trust"),
                    F.floor(F.count(F.when(F.col("ruled") == "block", 1)) * UNIT / n).alias("distrust")))
    return by_host.select("node", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (kind, seed)")).filter("seed > 0")


def _flows(edges: DataFrame) -> DataFrame:
    """(kind, node, to, parts): trust runs along a link, distrust against it; ``parts`` is among how many."""
    both = (edges.select(F.lit("trust").alias("kind"), F.col("src").alias("node"), F.col("dst").alias("to"))
            .unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("node"), F.col("src").alias("to"))))
    return both.join(both.groupBy("kind", "node").agg(F.count("*").alias("parts")), ["kind", "node"])


def propagate(seed: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, node, score) after the scores have settled, or after ``rounds``."""
    seed = written(seed, "trust-seeds")
    flows = written(_flows(edges), "trust-flows")
    scores = seed.withColumnRenamed("seed", "score")
    before = None
    for _ in range(rounds):
        arrived = (scores.join(flows, ["kind", "node"])
                   .groupBy("kind", F.col("to").alias("node")).agg(F.sum(F.expr("score div parts")).alias("inflow")))
        scores = written(
            seed.join(arrived, ["kind", "node"], "full_outer")
                .select("kind", "node", F.expr(f"(coalesce(seed, 0) * {100 - DAMPING}) div 100"
                                               f" + (coalesce(inflow, 0) div 100) * {DAMPING}"
                                               f" + ((coalesce(inflow, 0) % 100) * {DAMPING}) div 100").alias("score"))
                .filter("score > 0"), "trust-scores")
        now = tuple(scores.agg(F.count("*"), F.bit_xor(F.xxhash64("kind", "node", "score")),
                               F.sum(F.xxhash64("kind", "node", "score").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return scores


def judge(pages: DataFrame, rules=RULES, block_at: int = BLOCK_AT, rounds: int = ROUNDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page; scores are 0 where none arrived."""
    judged = parsed(pages, rules)
    scores = propagate(seeds(judged), host_edges(pages), rounds)
    hosts = (scores.groupBy(F.col("node").alias("_host"))
             .agg(F.max(F.when(F.col("kind") == "trust", F.col("score"))).alias("_t"),
                  F.max(F.when(F.col("kind") == "distrust", F.col("score"))).alias("_d")))
    t, d = F.coalesce("_t", F.lit(0)), F.coalesce("_d", F.lit(0))
    own = F.when((d >= block_at) & (d > t), F.lit("block")).otherwise(F.lit("allow"))
    return (judged.join(hosts, judged.host == hosts._host, "left")
            .select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
                    t.cast("long").alias("trust"), d.cast("long").alias("distrust")))


def oracle_sql(rules=RULES, block_at: int = BLOCK_AT, rounds: int = ROUNDS) -> str:
    """DuckDB SQL of ``judge``: the rounds as a recursive query."""
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def first(value) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = {q(r.host)} OR ends_with(host, {q('.' + r.host)})) AND starts_with(path, {q(r.path)}) THEN {q(value(r))}"
            for r in _ranked(rules)) + " END"

    def host(c: str, pattern: str) -> str:
        return f"translate(regexp_extract({c}, {q(pattern)}, 1), '{UPPER}', '{LOWER}')"
    return f"""
WITH RECURSIVE parsed AS (
  SELECT page_id, {host("coalesce(url, '')", URL)} AS host, regexp_extract(coalesce(url, ''), {q(URL)}, 2) AS path FROM pages),
judged AS (SELECT *, {first(lambda r: r.text)} AS rule, {first(lambda r: r.verdict)} AS ruled FROM parsed),
links AS (
  SELECT {host("coalesce(url, '')", URL)} AS src, unnest(regexp_extract_all(coalesce(html, ''), {q(HREF)}, 1)) AS link FROM pages),
edges AS (
  SELECT DISTINCT src, dst FROM (SELECT src, {host("link", LINK)} AS dst FROM links) WHERE src <> '' AND dst <> '' AND src <> dst),
flows AS (
  SELECT *, count(*) OVER (PARTITION BY kind, node) AS parts FROM (
    SELECT 'trust' AS kind, src AS node, dst AS "to" FROM edges UNION ALL SELECT 'distrust', dst, src FROM edges)),
seeds AS (
  SELECT 'trust' AS kind, host AS node, count(*) FILTER (ruled = 'allow') * {UNIT} // count(*) AS seed
  FROM judged WHERE host <> '' GROUP BY host
  UNION ALL
  SELECT 'distrust', host, count(*) FILTER (ruled = 'block') * {UNIT} // count(*) FROM judged WHERE host <> '' GROUP BY host),
nodes AS (
  SELECT kind, node, coalesce(max(seed), 0) AS seed FROM (
    SELECT kind, node, seed FROM seeds UNION ALL SELECT kind, "to", NULL FROM flows) GROUP BY kind, node),
scores AS (
  SELECT kind, node, seed AS score, 0 AS round FROM nodes
  UNION ALL
  SELECT kind, node, CAST((sum(seed) * {100 - DAMPING}) // 100 + (sum(inflow) // 100) * {DAMPING}
                          + ((sum(inflow) % 100) * {DAMPING}) // 100 AS BIGINT), round + 1
  FROM (SELECT n.kind, n.node, n.seed, 0 AS inflow, r.round FROM nodes n CROSS JOIN (SELECT max(round) AS round FROM scores) r
        UNION ALL
        SELECT f.kind, f."to", 0, s.score // f.parts, s.round FROM scores s JOIN flows f ON f.kind = s.kind AND f.node = s.node)
  WHERE round < {rounds} GROUP BY kind, node, round),
hosts AS (
  SELECT node, max(CASE WHEN kind = 'trust' THEN score END) AS t, max(CASE WHEN kind = 'distrust' THEN score END) AS d
  FROM scores WHERE round = {rounds} GROUP BY node)
SELECT page_id, host, path, rule,
       coalesce(ruled, CASE WHEN coalesce(d, 0) >= {block_at} AND coalesce(d, 0) > coalesce(t, 0) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(t, 0) AS trust, coalesce(d, 0) AS distrust
FROM judged LEFT JOIN hosts ON hosts.node = judged.host"""
