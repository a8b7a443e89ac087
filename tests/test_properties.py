"""Property tests for the numeric building blocks."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.functions import scalars as S
from emporia.functions.ids import dense_ids
from emporia.functions.windows import running_sum


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 12), st.integers(1, 10 ** 6)), min_size=1, max_size=60),
       st.integers(0, 4))
def test_half_up_div_matches_decimal(spark, pairs, scale):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [(r.a, r.b) for r in df.select(S.half_up_div("n", "d", scale).alias("a"),
                                         S.half_up_div_wide("n", "d", scale).alias("b")).collect()]
    q = Decimal(1).scaleb(-scale)
    want = [(Decimal(n) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP) for n, d in pairs]
    assert [a for a, _ in got] == want
    assert [b for _, b in got] == want


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=200), st.integers(1, 7))
def test_dense_ids_equal_sorted_position(spark, rows, parts):
    df = spark.createDataFrame(rows, "a long, b long")
    got = sorted((r.id, r.a, r.b) for r in dense_ids(df, ["a", "b"], "id", 10, num_partitions=parts).collect())
    want = [(10 + i, a, b) for i, (a, b) in enumerate(sorted(rows))]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sorted((a, b) for _, a, b in got) == sorted(rows)
    # ids follow the order of (a, b)
    by_id = [(a, b) for _, a, b in sorted(got)]
    assert by_id == sorted(rows)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 200), st.integers(1, 9)), min_size=1, max_size=150))
def test_ranged_running_sum_equals_window(spark, rows):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = [(k, t, i, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k long, t long, i long, v long")
    got = running_sum(df, ["k"], ["t", "i"], {"rs": F.col("v")})
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("rs", F.sum("v").over(w))
    assert sorted(map(tuple, got.select("k", "t", "i", "rs").collect())) == \
        sorted(map(tuple, want.select("k", "t", "i", "rs").collect()))


def test_drop_scratch_removes_id_tables(spark):
    import os
    from emporia.session import _SCRATCH, drop_scratch
    df = dense_ids(spark.range(0, 50).withColumnRenamed("id", "a"), ["a"], "id")
    paths = list(_SCRATCH)
    assert df.count() == 50 and paths and all(os.path.exists(p) for p in paths)
    assert drop_scratch(spark) == len(paths)
    assert not any(os.path.exists(p) for p in paths)
