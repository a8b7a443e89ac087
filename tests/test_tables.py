"""Catalog tables and bucketed merges, partitioned histories, and comparison by digests."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import digests as D
from emporia.operators import sync as Y
from emporia.operators import versions as V
from emporia.session import path_exists
from emporia.sources import catalog_tables as C
from emporia.sources.history import History
from emporia.sources.tables import Tables

FEED = "id long, v string, _change_type string, _commit_version long, _commit_ts timestamp_ntz, _seq int"
T0 = dt.datetime(2020, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def feed(seed, n=600, keys=40, in_order=True):
    """Random inserts, updates and deletes; a third of them on one key."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rng.random() < 0.33 else rng.randrange(keys)
        version = i if in_order else max(0, i + rng.randint(-30, 30))
        out.append((key, rng.choice(["a", "b", None]), rng.choice(["insert", "update_postimage", "update_preimage", "delete"]), version,
                    T0 + dt.timedelta(hours=9 * i), i % 3 if in_order else i))
    return out


# --- A4, A9, E8 -----------------------------------------------------------------------

@pytest.fixture()
def name():
    return f"t_{uuid.uuid4().hex[:10]}"


def test_declared_table_reads_back_through_the_catalog(spark, name):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("price", T.DecimalType(18, 2), True, {"comment": "list price, it's net"}),
                           T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("at", T.TimestampNTZType())])
    C.create_table(spark, name, schema, ["id"], comment="it's a \\ test", properties={"change_feed": "true", "owner's": "x"}, buckets=4)
    got = spark.table(name).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schema]
    assert spark.catalog.getTable(name).description == "it's a \\ test"
    assert {c.name: c.description for c in spark.catalog.listColumns(name)}["price"] == "list price, it's net"
    about = C.describe(spark, name)
    assert (about["buckets"], about["keys"]) == (4, ["id"])
    assert about["properties"]["change_feed"] == "true" and about["properties"]["owner's"] == "x"
    assert spark.table(name).count() == 0
    with pytest.raises(Exception, match="already exists"):
        C.create_table(spark, name, schema, ["id"])
    C.load(spark.createDataFrame([(1, None, ["a"], None), (2, None, None, T0)], schema), name)
    assert rows(spark.table(name)) == [(1, None, ["a"], None), (2, None, None, T0)]
    assert C.describe(spark, name)["comment"] == "it's a \\ test"


@pytest.mark.parametrize("seed", range(3))
def test_bucketed_merges_equal_the_state(spark, name, seed):
    changes = spark.createDataFrame(feed(seed, in_order=False), FEED)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    C.create_table(spark, name, schema, ["id"], buckets=5)
    C.load(V.state_at_version(changes, ["id"], 200), name)
    old = spark.table(name)
    before = rows(old)
    for lo, hi in ((200, 400), (400, 500), (500, 10_000)):
        C.merge(spark, name, changes, lo, hi)
        assert rows(spark.table(name)) == rows(Y.sync_triggered(V.state_at_version(changes, ["id"], lo), changes, ["id"], lo, hi))
    again = rows(spark.table(name))
    C.merge(spark, name, changes, 500)  # the same changes once more
    assert rows(spark.table(name)) == again
    assert rows(old) == before  # who reads the old folder is not disturbed


def test_a_small_merge_exchanges_the_feed_only(spark, name, sf_dir):
    t = Tables(spark, sf_dir)
    C.create_table(spark, name, t.orders.schema, ["id"])
    C.load(t.orders, name)
    changes = spark.createDataFrame(t.order_changes.filter("id % 100 = 7").collect(), t.order_changes.schema)
    plan = C.merged(spark, name, changes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan
    at = plan.index("Exchange")
    # The one exchange stands above the feed; the table's scan is bucketed and on the join's other side.
    assert "Bucketed: true" in plan and plan.index("Bucketed: true") < at and "Scan ExistingRDD" in plan[at:]
    files = [f for f in spark.table(name).inputFiles()]
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))  # one file a bucket


# --- G1, G2, G9 -----------------------------------------------------------------------

@pytest.mark.parametrize("in_order", [True, False])
def test_history_equals_the_whole_log_at_any_time(spark, scratch, in_order):
    changes = feed(7, 500, in_order=in_order)
    df = spark.createDataFrame(changes, FEED)
    h = History(spark, scratch + "/h", ["id"])
    h.append(df.filter("_commit_version < 250"))
    h.append(df.filter("_commit_version >= 250"))
    assert rows(h.as_of(T0 + dt.timedelta(days=40))) == rows(V.as_of(df, ["id"], T0 + dt.timedelta(days=40)).select("id", "v"))  # no state yet
    times = [T0 + dt.timedelta(days=d) for d in (90, 30, 120, 31)]
    h.write_states(times)
    h.snapshot("by hand", T0 + dt.timedelta(days=60))
    for at in (*times, T0 + dt.timedelta(days=60)):
        assert rows(h.state(at)) == rows(V.as_of(df, ["id"], at).select("id", "v"))
    for day in (-1, 0, 1, 29, 30, 45, 60, 61, 100, 130, 187, 500):
        at = T0 + dt.timedelta(days=day, hours=5)
        assert rows(h.as_of(at)) == rows(V.as_of(df, ["id"], at).select("id", "v")), day
    with pytest.raises(V.RestoreWindowError):
        h.as_of(T0, now=T0 + dt.timedelta(days=31))


def test_as_of_reads_one_state_and_the_months_behind_it(spark, scratch):
    df = spark.createDataFrame(feed(3, 900), FEED)
    h = History(spark, scratch + "/h", ["id"])
    h.append(df)
    h.write_states([T0 + dt.timedelta(days=d) for d in (60, 120, 180, 240)])
    at = T0 + dt.timedelta(days=200)
    plan = h.as_of(at)._jdf.queryExecution().executedPlan().toString()
    state = int((T0 + dt.timedelta(days=180)).replace(tzinfo=dt.timezone.utc).timestamp())
    assert f"(at#" in plan and f"= {state})" in plan
    assert "_month#" in plan and ">= 202006)" in plan and "<= 202007)" in plan
    scans = [x for x in plan.split("\n") if "PartitionFilters" in x]
    assert scans and all("PartitionFilters: []" not in x for x in scans)


def test_expiry_deletes_scheduled_states_and_keeps_snapshots(spark, scratch):
    h = History(spark, scratch + "/h", ["id"])
    h.append(spark.createDataFrame(feed(1, 300), FEED))
    assert h.marks().count() == 0
    days = lambda n: T0 + dt.timedelta(days=n)
    h.write_states([days(10), days(50), days(80)])
    h.snapshot("keep", days(20))
    left = h.expire(days(90), 30)
    want = [("manual", "keep", days(20)), ("scheduled", None, days(80))]
    assert rows(left) == want and rows(h.marks().drop("at")) == want
    assert [path_exists(spark, f"{scratch}/h/states/at={int(days(n).replace(tzinfo=dt.timezone.utc).timestamp())}") for n in (10, 20, 50, 80)] \
        == [False, True, False, True]
    at = days(55)  # falls back to the state that is left and a longer tail
    assert rows(h.as_of(at)) == rows(V.as_of(h.log(), ["id"], at).select("id", "v"))


# --- G4, A17, G7 ----------------------------------------------------------------------

def table(spark, n, change=lambda r: r):
    return spark.createDataFrame([change((i, i % 5, None if i % 3 else f"v{i}")) for i in range(n)], "id long, a int, b string")


def test_equal_tables_join_nothing(spark):
    trace = []
    t = table(spark, 3000)
    out = D.row_diff_by_ranges(t, t.repartition(5), ["id"], trace=trace)
    assert out.count() == 0 and trace == [(1, 0)]  # the roots are equal: no descent


def test_few_changes_open_few_ranges(spark):
    old = table(spark, 5000)
    new = table(spark, 5001, lambda r: (r[0], r[1], "new" if r[0] == 17 else r[2])).filter("id <> 4000")
    trace = []
    got = D.row_diff_by_ranges(old, new, ["id"], trace=trace)
    assert rows(got) == [(17, "changed"), (4000, "removed"), (5000, "added")] == rows(V.row_diff(old, new, ["id"]))
    assert trace[0] == (1, 1) and trace[1][1] <= 3 and trace[2][0] <= 3 * 64 and trace[2][1] <= 3


@pytest.mark.parametrize("seed", range(3))
def test_ranges_find_what_the_full_join_finds(spark, seed):
    rng = random.Random(seed)
    key = lambda: (rng.choice([None, *range(60)]), rng.choice(["x", "y", None]))
    make = lambda: list({k: (*k, rng.choice([None, 1, 2])) for k in (key() for _ in range(70))}.values())
    schema = "k long, l string, a int"
    a, b = spark.createDataFrame(make(), schema).filter("k IS NOT NULL AND l IS NOT NULL"), spark.createDataFrame(make(), schema).filter("k IS NOT NULL AND l IS NOT NULL")
    assert rows(D.row_diff_by_ranges(a, b, ["k", "l"], bits=6)) == rows(V.row_diff(a, b, ["k", "l"]))
    assert rows(D.sync_verify_by_ranges(a, b, ["k", "l"])) == rows(Y.sync_verify(a, b, ["k", "l"]))
    empty = a.limit(0)
    assert rows(D.sync_verify_by_ranges(a, empty, ["k", "l"])) == rows(Y.sync_verify(a, empty, ["k", "l"]))
    assert rows(D.sync_verify_by_ranges(empty, empty, ["k", "l"])) == [(0, 0, 0, 0, 0)]


def test_digests_merge_to_the_root(spark):
    tree = D.digest_tree(table(spark, 700), ["id"], ["a", "b"])
    low, root = tree.levels[0].collect(), tree.levels[-1].collect()
    assert len(root) == 1 and root[0].node == 0 and root[0].n == 700 == sum(r.n for r in low)
    x = 0
    for r in low:
        x ^= r.x1
    assert x == root[0].x1 and len(tree.levels) == 3
    with pytest.raises(ValueError):
        D.digest_tree(table(spark, 1), ["id"], [], bits=5)


def test_reset_shows_what_the_child_loses(spark):
    parent = table(spark, 50)
    child = table(spark, 53, lambda r: (r[0], 9 if r[0] < 4 else r[1], r[2])).filter("id NOT IN (10, 11)")
    assert rows(D.drift(child, parent, ["id"])) == [(3, 2, 4)]
    assert rows(D.drift(parent, parent, ["id"])) == [(0, 0, 0)]
