"""Secret scans with multipart credential linking.

Every text is scanned for *parts*: strong ones, which are reported as they are
(an assignment to a password-like name, an access id, a long hex string), and weak ones,
which alone prove nothing:

* ``secret``: a run of 40 characters or more of the base64 alphabet that
  mixes cases and digits (how secret keys are written);
* ``user``: an account or user name that is assigned;
* ``endpoint``: a URL with a host, or a host with a port.

A *scope* is a part with the ``SCOPE_CHARS`` characters before and after it, so distances are
measured from the end of the earlier part to the start of the later one. Parts are
interval-joined within scopes; a weak part is reported only where
complementary ones co-occur:

* ``secret``: an access id, user or endpoint within the scope;
* ``user``: a strong assignment, or a ``secret`` with an endpoint, within the scope;
* ``endpoint``: an access id or user, together with an assignment, hex string or ``secret``.

The join is an equi-join on (text, stretch number): every part is put in the stretches that it
touches, a weak one in those that its scope touches. The side that is looked up is first reduced to
the first start and the last end of each kind in a stretch. These two tell whether a kind is within
the scope: what touches an inner stretch is, in the scope's first stretch the last end decides, in its last
one the first start. So a text full of parts never makes pairs: the join gives as many rows for a weak part
as its scope touches stretches (four at most, and one more for each ``SCOPE_CHARS`` characters of the part).

Only parts are shuffled, and only those of texts that hold a weak and a complementary one;
texts are scanned where they lie. Texts are known by (doc_id, hash of the text).

Defined results: a null or empty text has no spans and the digest of the empty string. Rows
that repeat a doc_id and text get the same result each. Very long texts are scanned whole: no
pattern takes more than a number of steps in proportion to the text, whatever stands in it. An empty table gives an empty result.
Extra columns are not read.
"""

from __future__ import annotations

import re
from functools import reduce
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import map_rows, written

SCOPE_CHARS = 400

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "secret", "user", "endpoint")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
# Shorter runs would be dropped, and a run has no longer match within; so the least length is in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SECRET = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}(?![A-Za-z0-9+/=])")
USER = re.compile(r"""\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([\w.@+-]{3,})""", re.I | re.A)
# An endpoint is found from its middle, ``://`` or a colon with a port, and extended to the left from there, so
# long runs of host or scheme characters are not tried from each of their places.
SCHEME_TAIL = re.compile(r"://[^\s/\"'<>]+", re.A)
PORT = re.compile(r"(?<=[A-Za-z]{2}):\d{2,5}\b", re.A)
SCHEME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
HOST = re.compile(r"(?:[a-z0-9-]+\.)+[a-z]{2,}\Z", re.I | re.A)
HOST_CHARS = SCHEME_CHARS - {"+"}

SCHEMA = ("doc_id long, th long, n_assign long, n_access long, n_hex long, base array<struct<kind:int,first:int,last:int>>, "
          "weak array<struct<kind:int,first:int,last:int>>")


def strong_parts(text: str) -> list[tuple[int, int, int]]:
    """(kind, first, last) of the base matches, by start and then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda p: (p[1], p[0]))


def _left(text: str, end: int, chars: frozenset, floor: int) -> int:
    """Where the run of ``chars`` before ``end`` starts, at ``floor`` at least."""
    while end > floor and text[end - 1] in chars:
        end -= 1
    return end


def endpoints(text: str) -> list[tuple[int, int]]:
    """(first, last) of URLs with a host and of hosts with a port, from left to right, none within another."""
    found, free = [], 0  # nothing before ``free`` is looked at again
    tails = sorted([(m.start(), m.end(), True) for m in SCHEME_TAIL.finditer(text)] + [(m.start(), m.end(), False) for m in PORT.finditer(text)])
    for at, end, url in tails:
        if at < free:
            continue
        first = _left(text, at, SCHEME_CHARS if url else HOST_CHARS, free)
        if url:
            while first < at and not text[first].isalpha():  # a scheme begins with a letter
                first += 1
            ok = first < at
        else:
            gap = text.rfind("..", first, at)
            first = first if gap < 0 else gap + 2
            while first < at and text[first] == ".":
                first += 1
            ok = bool(HOST.match(text, first, at))
        if ok:
            found.append((first, end))
        free = end if ok else at
    return found


def weak_parts(text: str) -> list[tuple[int, int, int]]:
    found = [(3, m.start(), m.end()) for m in SECRET.finditer(text)
             if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0])]
    if ":" in text or "=" in text:
        found += [(4, m.start(), m.end()) for m in USER.finditer(text)]
        found += [(5, a, b) for a, b in endpoints(text)]
    return sorted(found, key=lambda p: (p[1], p[0]))


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each text with its strong and weak parts."""
    def make():
        def step(batch):
            base = [strong_parts(t.as_py() or "") for t in batch.column(1)]
            weak = [weak_parts(t.as_py() or "") for t in batch.column(1)]
            as_struct = lambda rows: [[{"kind": k, "first": a, "last": b} for k, a, b in r] for r in rows]
            yield {"doc_id": batch.column(0), "th": batch.column(2), "base": as_struct(base), "weak": as_struct(weak)} | {
                f"n_{KINDS[k]}": [sum(p[0] == k for p in r) for r in base] for k in range(3)}
        return step

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                F.xxhash64(F.col(text_col)).alias("th")), SCHEMA, make)


def linked_parts(scanned: DataFrame, scope: int = SCOPE_CHARS) -> DataFrame:
    """doc_id, th, linked: the weak parts of each text that have complementary parts in their scope."""
    texts = (scanned.filter((F.size("weak") > 0) & (F.size("weak") + F.size("base") > 1))
             .select("doc_id", "th", "base", "weak").dropDuplicates(["doc_id", "th"]))
    parts = texts.select("doc_id", "th", F.inline(F.concat("base", "weak")))
    # The first start and the last end of each kind in a stretch.
    ends = [x for k in range(len(KINDS)) for x in (
        F.min(F.when(F.col("kind") == k, F.col("first"))).alias(f"lo{k}"),
        F.max(F.when(F.col("kind") == k, F.col("last"))).alias(f"hi{k}"))]
    places = (parts.withColumn("o_stretch", F.explode(F.expr(f"sequence(first div {scope}, last div {scope})")))
              .groupBy(F.col("doc_id").alias("o_id"), F.col("th").alias("o_th"), "o_stretch").agg(*ends))
    weak = parts.filter("kind >= 3").withColumn(
        "stretch", F.explode(F.expr(f"sequence(greatest(first - {scope}, 0) div {scope}, (last + {scope}) div {scope})")))
    met = weak.join(places, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("th") == F.col("o_th"))
                    & (F.col("stretch") == F.col("o_stretch")))

    def near(k: int):
        # Each holds by itself in all stretches of the scope but its last and its first one.
        within = (F.col(f"lo{k}") <= F.col("last") + scope) & (F.col(f"hi{k}") >= F.col("first") - scope)
        return F.max(F.coalesce(within, F.lit(False))).alias(f"near{k}")

    seen = met.groupBy("doc_id", "th", "kind", "first", "last").agg(*[near(k) for k in range(len(KINDS))])
    assign, access, hexa, secret, user, endpoint = (F.col(f"near{k}") for k in range(len(KINDS)))
    kind = F.col("kind")
    reported = (((kind == 3) & (access | user | endpoint))
                | ((kind == 4) & (assign | (secret & endpoint)))
                | ((kind == 5) & (access | user) & (assign | hexa | secret)))
    return (seen.filter(reported).groupBy("doc_id", "th")
            .agg(F.collect_list(F.struct("kind", "first", "last")).alias("linked")))  # at most one text's parts


def _listed(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda p: F.struct(p["first"].alias("first"), p["kind"].alias("kind"), p["last"].alias("last"))))
    return F.array_join(F.transform(by_start, lambda p: F.concat_ws(
        ":", F.element_at(names, p["kind"] + 1), p["first"], p["last"])), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE_CHARS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row for each row of ``docs``.

    Spans are kind:start:end in code points, end exclusive, by start and then kind, joined by commas.
    """
    scanned = written(scan(docs, id_col, text_col), "parts")
    linked = linked_parts(scanned, scope).select(F.col("doc_id").alias("l_id"), F.col("th").alias("l_th"), "linked")
    none = F.array().cast("array<struct<kind:int,first:int,last:int>>")
    return (scanned.join(linked, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("th") == F.col("l_th")), "left")
            .select("doc_id", "n_assign", "n_access", "n_hex",
                    F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                    _listed(F.concat("base", F.coalesce("linked", none))).alias("spans")))
