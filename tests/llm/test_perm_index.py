import numpy as np

from emporia.llm import perm_index as P


def brute(rows, k=5, every=50):
    rows = [(i, np.array(v, np.float64)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in rows:
        if q % every == 0:
            scores = [(-float(a @ b / np.sqrt((a @ a) * (b @ b))), i) for i, b in rows if i != q and len(a) == len(b)]
            out[q] = sorted((round(s, 9), i) for s, i in scores)[:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def random_rows(n, seed=1, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims))
    return [(i, (centres[i % 12] + rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]


def recall(got, want):
    hit = sum(len({r.vec_id for r in got if r.query_id == q} & {i for _, i in best}) for q, best in want.items())
    return hit / sum(map(len, want.values()))


def test_recall_and_exact_scores(spark):
    rows = random_rows(4000)
    want = brute(rows)
    got = P.search(frame(spark, rows)).collect()
    assert recall(got, want) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for r in got:
        a, b = vectors[r.query_id], vectors[r.vec_id]
        assert abs(r.score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
    for q in want:
        own = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [x[0] for x in own] == [1, 2, 3, 4, 5] and own == sorted(own, key=lambda x: (-x[1], x[2]))


def test_footrule_equals_the_plain_one():
    rng = np.random.default_rng(2)
    rows, pivots = rng.normal(size=(300, 8)), P._unit(rng.normal(size=(20, 8)))
    shard = P.Shard(np.arange(300), rows, pivots, 6)
    first = P.prefixes(shard.units, pivots, 6)
    for q in range(5):
        for i, d in enumerate(shard.footrule(first[q]).tolist()):
            at, own = first[i].tolist(), first[q].tolist()
            assert d == sum(abs((at.index(p) if p in at else 6) - (own.index(p) if p in own else 6)) for p in {*at, *own})


def test_small_tables_are_exact_with_ties_and_odd_vectors(spark):
    rows = random_rows(120) + [(200 + i, [1.0] * 16) for i in range(9)] + [
        (300, None), (301, [0.0] * 16), (302, [None] * 16), (303, [float("nan")] * 16), (304, [float("inf")] * 16), (305, []),
        (None, [1.0] * 16), (350, [2.0] * 16), (400, [1.0, 2.0]), (401, [2.0, 1.0]), (7, random_rows(8)[7][1]), (450, [1e30] * 16)]
    got = P.search(frame(spark, rows).selectExpr("*", "1 AS v", "2 AS score")).collect()
    want = brute(list({(i, tuple(v) if v else None): (i, v) for i, v in rows}.values()))
    assert {q: [i for _, i in best] for q, best in want.items()} == {
        q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in want}
    assert {r.query_id for r in got} == {q for q, best in want.items() if best}
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 350] == [200, 201, 202, 203, 204]


def test_query_blocks_change_nothing(spark):
    rows = random_rows(1500, seed=4)
    whole, parts = P.search(frame(spark, rows)), P.search(frame(spark, rows), query_block=7)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def test_common_vector_and_its_near_ones(spark):
    rng = np.random.default_rng(3)
    rows = random_rows(2500, seed=5)
    hot = np.array(rows[0][1])
    for i in range(0, 2500, 3):
        rows[i] = (i, (hot + rng.normal(size=16) * 1e-3 * (i % 2)).astype(np.float32).tolist())
    assert recall(P.search(frame(spark, rows)).collect(), brute(rows)) >= 0.9


def near_copies(noise, n=8192, dims=64):
    """(recall of the queries among the copies, of all) in one shard; a third of it are copies of one vector with noise."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(n, dims)).astype(np.float32)
    rows[::3] = rows[0] + rng.normal(size=(len(rows[::3]), dims)).astype(np.float32) * noise
    rows = rows.astype(np.float64)
    sample = P._unit(rows[rng.permutation(n)[:P.SAMPLE]])
    pivots = sample[P.spread(sample, P.PIVOTS)]
    shard, units = P.Shard(np.arange(n), rows, pivots, P.PREFIX), P._unit(rows)
    hits = {True: [], False: []}
    for q in range(0, n, 100):
        scores = P.cosine(rows[q], rows)
        best = [i for i in np.lexsort((np.arange(n), -scores))[:P.K + 1].tolist() if i != q][:P.K]
        found, _ = shard.nearest(q, rows[q], units[q], P.prefixes(units[q:q + 1], pivots, P.PREFIX)[0], P.K, P.SHARE)
        hits[q % 3 == 0].append(len({*found} & {*best}) / P.K)
    return np.mean(hits[True]), np.mean(hits[True] + hits[False])


def test_a_third_of_near_copies_is_not_cut():
    for noise in (1e-6, 1e-5, 1e-4, 1e-3, 1e-2):
        hot, every = near_copies(noise)
        assert hot == 1 and every >= 0.9, (noise, hot, every)


def test_empty(spark):
    assert P.search(frame(spark, [])).count() == 0
    assert P.search(frame(spark, [(3, [1.0])])).count() == 0


def test_shards_are_merged(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_ROWS", 1200)
    rows = random_rows(4000, seed=8)  # four shards
    want = brute(rows)
    got = P.search(frame(spark, rows)).collect()
    assert recall(got, want) >= 0.9
    assert all(sorted(r.rank for r in got if r.query_id == q) == [1, 2, 3, 4, 5] for q in want)
    small = random_rows(90, seed=9)  # every shard is searched whole: exact, ties by id over the shards
    small += [(100 + i, small[0][1]) for i in range(12)]
    monkeypatch.setattr(P, "SHARD_ROWS", 20)
    assert {q: [i for _, i in best] for q, best in brute(small).items()} == {
        q: [r.vec_id for r in sorted(P.search(frame(spark, small)).collect(), key=lambda r: r.rank) if r.query_id == q] for q in brute(small)}
