import hashlib
import random
import zlib

import duckdb
import pytest
from emporia.llm import merkle as M
from helpers import as_set, empty_docs, odd_docs
from pyspark.sql import functions as F

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """The last node, and each node's siblings from the lowest level up."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, joined = [], []
        for s in range(0, len(nodes), 16):
            run = nodes[s:s + 16]
            for k in range(len(run)):
                for i in groups[s + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(H(*run))
            joined.append([i for k in range(len(run)) for i in groups[s + k]])
        nodes, groups = up, joined
    return nodes[0], paths


def brute(rows):
    if not rows:
        return []
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for s in order:
        mine = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        done[s] = mine, *climb([leaf(r) for r in mine])
    root, tops = climb([done[s][1] for s in order])
    out = []
    for k, s in enumerate(order):
        mine, subroot, paths = done[s]
        for r, path in zip(mine, paths):
            whole = path + tops[k]
            t = r[4]
            if t is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            acc = leaf((*r[:4], t))
            for left, right in whole:
                acc = H(left, acc, right)
            out.append((r[0], leaf(r), subroot, root, H(*[x for seg in whole for x in seg]), acc, acc == root))
    return sorted(out, key=repr)


def corpus(sizes, seed=1):
    rng = random.Random(seed)
    rows, d = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            d += 1
            rows.append((d, f"s{s}" if s else None, rng.choice(["en", None]), d % 7, rng.choice(["Big Text É", "small text", None, ""])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [(1,), (2,), (16,), (17,), (0, 1), (300, 1, 16, 17, 33), (1,) * 19, (5,) + (1, 2) * 130])
def test_equals_brute_force(spark, sizes):
    rows = corpus(sizes)
    assert as_set(M.audit(spark.createDataFrame(rows, SCHEMA)), "*") == brute(rows)


def test_a_hot_source_of_several_heights(spark):
    rows = corpus((3, 4500, 20))
    got = as_set(M.audit(spark.createDataFrame(rows, SCHEMA).repartition(7)), "*")
    assert got == brute(rows)
    bad = [r for r in got if not r[-1]]
    assert bad and len(bad) == sum(zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] == "Big Text É" for r in rows)


def test_ties_repeated_rows_nulls_and_clashing_columns(spark):
    rows = [(1, "a", "en", 1, "X")] * 40 + [(1, "a", "en", 1, "y")] * 3 + [(None, "a", None, None, None)] * 20 + [(None, None, None, None, "T")] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("leaf", "rank", "n", "idx", "digest", "path", "place", "asked", "_s", "tampered"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert as_set(M.audit(docs), "*") == brute(rows)
    odd = odd_docs(spark)
    assert as_set(M.audit(odd), "*") == brute([tuple(r) for r in odd.select(*M.FIELDS).collect()])


def test_empty_table(spark):
    assert M.audit(empty_docs(spark)).count() == 0
    assert M.build(empty_docs(spark).select("source", "doc_id", F.lit("x").alias("leaf"))).root == H("")


def test_proofs_of_some_leaves_come_from_the_records_alone(spark):
    rows = corpus((300, 1, 40))
    leaves = spark.createDataFrame(rows, SCHEMA).select("source", "doc_id", M.leaf_digest().alias("leaf"))
    m = M.build(leaves)
    want = {r[1]: r for r in brute(rows)}
    asked = m.leaves.filter("rank IN (0, 17, 299)").select("source", "rank", "leaf")
    got = M.proofs(m, asked).select("leaf", "subroot", "path", M.fold(F.col("leaf"), F.col("path")).alias("root")).collect()
    assert len(got) == 6
    for r in got:
        assert r.root == m.root and r.subroot == want[r.leaf][2]
        assert H(*[x for s in r.path for x in (s.left, s.right)]) == want[r.leaf][4]
    # A record that was changed gives proofs that no longer fold to the root.
    forged = m.records[0].withColumn("children", F.transform("children", lambda c: F.reverse(c)))
    m.records[0] = forged
    bad = M.proofs(m, asked.filter("source IS NULL")).select(M.fold(F.col("leaf"), F.col("path")).alias("root")).collect()
    assert bad and all(r.root != m.root for r in bad)


def test_records_are_addressed_by_their_content(spark):
    leaves = spark.createDataFrame(corpus((70, 20)), SCHEMA).select("source", "doc_id", M.leaf_digest().alias("leaf"))
    m = M.build(leaves)
    for level in (*m.records, *m.top_records):
        for r in level.collect():
            assert r.digest == H(*r.children) and 1 <= len(r.children) <= 16


def test_sql(spark):
    documents = spark.createDataFrame(corpus((40, 1, 290), 4), SCHEMA).toArrow()  # noqa: F841
    want = duckdb.sql(M.oracle_sql()).fetchall()
    assert as_set(M.audit(spark.createDataFrame(corpus((40, 1, 290), 4), SCHEMA)), "*") == sorted(want, key=repr)
