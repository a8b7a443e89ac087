"""Versioned store, the three sync modes and the streaming jobs.

Invariants from the survey: A8 = A9 = A10 on the same history; replaying a
batch changes nothing; as-of(latest) = current; migrations are idempotent.
"""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import versions as V
from emporia.operators.cart import cart_state
from emporia.plans.q_versions import STEPS
from emporia.sources.store import TableStore, sync_continuous, sync_snapshot, sync_triggered
from emporia.sources.tables import Tables
from emporia.streaming.jobs import cart_state_stream, row_activity_stream, working_set_stream
from emporia.operators.activity import row_activity

KEYS = ["id"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def t(spark, sf_dir):
    return Tables(spark, sf_dir)


def test_store_versions_and_snapshots(spark, scratch):
    st = TableStore(spark, scratch + "/store")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    assert st.create("promos", schema, comment="spring sale", properties={"cdf": "true"}, keys=KEYS) == 0
    assert st.read("promos").count() == 0 and st.read("promos").schema == schema
    v1 = st.overwrite(spark.createDataFrame([(1, "a"), (2, "b")], schema), "promos")
    v2 = st.append(spark.createDataFrame([(3, "c")], schema), "promos")
    snap = st.snapshot("promos", "before-sale")
    v4 = st.overwrite(spark.createDataFrame([(9, "z")], schema), "promos")
    assert _rows(st.read("promos", v1)) == [(1, "a"), (2, "b")]
    assert _rows(st.read("promos", v2)) == [(1, "a"), (2, "b"), (3, "c")]
    assert _rows(st.read("promos", snap)) == _rows(st.read("promos", v2))
    assert _rows(st.read("promos")) == [(9, "z")] and st.latest_version("promos") == v4


def test_sync_modes_agree(spark, scratch, t):
    changes = t.order_changes
    # A8 snapshot at version 60, then A9 appends the rest.
    st = TableStore(spark, scratch + "/serving")
    base = V.state_at_version(changes, KEYS, 60)
    sync_snapshot(st, base, "orders", keys=KEYS, source_version=60)
    assert sync_triggered(st, changes, "orders") is not None
    assert sync_triggered(st, changes, "orders") is None  # nothing newer: no new version
    triggered = st.read("orders")
    latest = V.state_at_version(changes, KEYS, 10 ** 6)
    assert _rows(triggered) == _rows(latest)
    # Snapshot of the full state equals it too, and folding the changes into a new copy keeps it.
    st2 = TableStore(spark, scratch + "/serving2")
    sync_snapshot(st2, latest, "orders", keys=KEYS)
    assert _rows(st2.read("orders")) == _rows(latest)
    sync_snapshot(st, st.read("orders"), "orders")
    assert _rows(st.read("orders")) == _rows(latest)


def test_sync_continuous_idempotent_restart(spark, scratch, t):
    changes = t.order_changes
    src = scratch + "/feed"
    changes.filter("_commit_version <= 40").write.parquet(src + "/a")
    changes.filter("_commit_version > 40").write.parquet(src + "/b")
    st = TableStore(spark, scratch + "/serving")
    empty = spark.createDataFrame([], t.orders.schema)
    sync_snapshot(st, empty, "orders", keys=KEYS, source_version=-1)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 2).parquet(src + "/*")
    q = sync_continuous(stream, st, "orders", scratch + "/ckpt")
    q.awaitTermination()
    n_versions = st.latest_version("orders")
    # Restart on the same checkpoint: nothing new, nothing re-applied.
    q = sync_continuous(spark.readStream.schema(changes.schema).parquet(src + "/*"), st, "orders", scratch + "/ckpt")
    q.awaitTermination()
    assert st.latest_version("orders") == n_versions
    assert _rows(st.read("orders")) == _rows(V.state_at_version(changes, KEYS, 10 ** 6))


def test_as_of_latest_equals_current(spark, t):
    c = t.order_changes
    top = c.agg(F.max("_commit_ts")).collect()[0][0]
    assert _rows(V.as_of(c, KEYS, top)) == _rows(V.state_at_version(c, KEYS, 10 ** 6))


def test_migrations_idempotent(spark, t):
    base = {"customers": t.customers, "orders": t.orders}
    once = V.replay_migrations(base, STEPS)
    twice = V.replay_migrations(once, STEPS)
    for k in base:
        assert once[k].columns == twice[k].columns
        assert _rows(once[k]) == _rows(twice[k])


def test_streaming_cart_equals_batch(spark, scratch, t):
    ce = t.cart_events
    ce.write.parquet(scratch + "/ce")
    stream = spark.readStream.schema(ce.schema).option("maxFilesPerTrigger", 1).parquet(scratch + "/ce")
    q = (cart_state_stream(stream, t.products).writeStream.outputMode("update")
         .foreachBatch(lambda df, bid: df.write.mode("append").parquet(scratch + f"/out/b={bid:06d}"))
         .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(scratch + "/out")
    # Last emitted cart per customer = final cart.
    last = out.groupBy("customer_id").agg(F.max("b").alias("b"))
    final = out.join(last, ["customer_id", "b"]).filter(F.col("product_id").isNotNull()).drop("b")
    assert _rows(final) == _rows(cart_state(ce, t.products))


def _run_cart_stream(spark, scratch, batches, products, **options):
    schema = "event_id long, customer_id long, ts timestamp_ntz, action string, product_id long, quantity int"
    for i, rows in enumerate(batches):  # one file, so one micro-batch each, in order
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/in/{i:03d}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(scratch + "/in/*")
    (cart_state_stream(stream, products, **options).writeStream.outputMode("update")
     .foreachBatch(lambda df, bid: df.write.mode("append").parquet(scratch + f"/out/b={bid:06d}"))
     .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True).start().awaitTermination())
    out = spark.read.parquet(scratch + "/out")
    last = out.groupBy("customer_id").agg(F.max("b").alias("b"))
    final = out.join(last, ["customer_id", "b"]).filter(F.col("product_id").isNotNull()).drop("b")
    return _rows(final), cart_state(spark.createDataFrame([r for b in batches for r in b], schema), products)


def test_streaming_cart_clears_nulls_large_ids_and_late_events(spark, scratch):
    import datetime as dt
    big = 2 ** 53 + 1
    products = spark.createDataFrame([(5,), (6,), (big,)], "id long")
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    batches = [
        [(1, 1, at(0), "add", 6, 2), (2, 1, at(10), "clear", None, None), (3, 1, at(20), "add", big, 3), (4, 2, at(0), "add", 5, 1),
         (5, 2, at(5), "update", 5, None), (6, 2, at(9), "add", 5, 4), (7, 3, at(30), "update", 5, 7), (8, 4, at(1), "add", 99, 1)],
        # late: before events of the first batch
        [(9, 3, at(15), "add", 5, 2), (10, 1, at(12), "add", 5, 1), (11, 1, at(5), "add", 5, 9), (12, 2, at(7), "update", 5, 8)],
    ]
    got, batch = _run_cart_stream(spark, scratch, batches, products)
    assert got == _rows(batch) == [(1, 5, 1), (1, big, 3), (2, 5, 4), (3, 5, 7)]


def test_streaming_cart_state_expires(spark, scratch):
    import datetime as dt
    products = spark.createDataFrame([(5,)], "id long")
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    batches = [[(1, 1, day(0), "add", 5, 2)], [(2, 2, day(60), "add", 5, 1)], [(3, 2, day(61), "add", 5, 1)]]
    got, _ = _run_cart_stream(spark, scratch, batches, products, expire="10 days")
    assert got == [(2, 5, 2)]  # the first customer's cart was abandoned


def test_state_writes_grow_with_events_not_with_carts(spark, scratch):
    import datetime as dt
    schema = "event_id long, customer_id long, ts timestamp_ntz, action string, product_id long, quantity int"
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    n = 400
    batches = [[(p, 1, at(0), "add", p, 1) for p in range(n)], [(n, 2, at(500), "add", 1, 1)], [(n + 1, 2, at(510), "add", 1, 1)],
               [(n + 2, 1, at(600), "add", 7, 2)], [(n + 3, 2, at(1200), "add", 2, 1)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/in/{i:03d}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(scratch + "/in/*")
    q = (cart_state_stream(stream, spark.range(n).selectExpr("id")).writeStream.outputMode("update").format("noop")
         .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    updated = {p["batchId"]: sum(x["numRowsUpdated"] for x in p["stateOperators"]) for p in q.recentProgress if p["stateOperators"]}
    assert updated[0] >= n  # the first batch's events
    one_event = [v for k, v in updated.items() if k >= 3]
    assert one_event and max(one_event) <= 12, updated  # an event, its timers and one line, beside a cart of 400


def test_streaming_activity_matches_batch_for_closed_windows(spark, scratch, t):
    ql = t.query_log
    ql.write.parquet(scratch + "/ql")
    s = spark.readStream.schema(ql.schema).parquet(scratch + "/ql")
    q = (row_activity_stream(s, "5 minutes", "0 seconds").writeStream.outputMode("append").format("memory")
         .queryName("act_test").option("checkpointLocation", scratch + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("select * from act_test").withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    want = row_activity(ql, "5 minutes")
    # Every emitted window equals the batch window; only the last open window may be missing.
    assert got.exceptAll(want).count() == 0
    assert want.count() - got.count() <= 1
    ws = working_set_stream(spark.readStream.schema(ql.schema).parquet(scratch + "/ql"))
    assert ws.isStreaming


def test_branch_isolation_reset_and_replay(spark, scratch, t):
    st = TableStore(spark, scratch + "/branches")
    st.overwrite(t.customers, "customers", keys=KEYS)
    st.overwrite(t.orders, "orders", keys=KEYS)
    n_parent = st.read("customers").count()
    st.overwrite(st.read("customers"), "customers@dev", keys=KEYS)
    new = spark.createDataFrame([(10 ** 9, "New Person", "new@example.com", "BUILDING", 1)], t.customers.schema)
    st.append(new, "customers@dev")
    # what the child gets is not visible on the parent
    assert st.read("customers").count() == n_parent
    assert st.read("customers@dev").count() == n_parent + 1
    # production drifts: another team adds email_verified on the parent
    from emporia.operators.orders import email_verified
    st.overwrite(email_verified(st.read("customers")), "customers")
    drift = {r.column_name: r.change for r in V.schema_diff(st.read("customers@dev"), st.read("customers")).collect()}
    assert drift == {"email_verified": "only_in_b"}
    # reset the child to the parent, then replay the child's migrations: both changes coexist
    replayed = V.reset_to_parent({"customers": st.read("customers@dev")}, {"customers": st.read("customers"),
                                                                          "orders": st.read("orders")}, STEPS)
    cols = replayed["customers"].columns
    assert "email_verified" in cols and "loyalty_points" in cols
    assert replayed["customers"].count() == n_parent
    # point in time: the version committed before the drift
    assert st.version_at("customers", st.latest("customers", 0)["created_at"]) is not None


SMALL = "id long, v string"
FEED = SMALL + ", _change_type string, _commit_version long, _commit_ts timestamp_ntz, _seq int"


def _feed(spark, *rows):
    return spark.createDataFrame([(i, v, kind, version, None, 0) for i, v, kind, version in rows], FEED)


def _small(spark, scratch, source_version=1):
    st = TableStore(spark, scratch + "/small")
    sync_snapshot(st, spark.createDataFrame([(1, "a"), (2, "b")], SMALL), "t", keys=KEYS, source_version=source_version)
    return st


def test_append_after_a_delete_stays(spark, scratch):
    st = _small(spark, scratch)
    st.append_changes(_feed(spark, (1, None, "delete", 5)), "t")
    st.append(spark.createDataFrame([(1, "again")], SMALL), "t")
    assert _rows(st.read("t")) == [(1, "again"), (2, "b")]
    # a later change replaces it, an earlier one that arrives late does not
    st.append_changes(_feed(spark, (1, "late", "update_postimage", 4)), "t")
    assert _rows(st.read("t")) == [(1, "again"), (2, "b")]
    st.append_changes(_feed(spark, (1, "new", "update_postimage", 6)), "t")
    assert _rows(st.read("t")) == [(1, "new"), (2, "b")]


def test_append_means_the_same_with_and_without_folding(spark, scratch):
    tables = []
    for fold in (False, True):
        st = _small(spark, scratch + str(fold))
        st.append_changes(_feed(spark, (3, "c", "insert", 5), (1, "x", "update_postimage", 5)), "t")
        if fold:
            sync_snapshot(st, st.read("t"), "t", source_version=5)
        st.append(spark.createDataFrame([(2, "second"), (3, "third")], SMALL), "t")
        tables.append(_rows(st.read("t")))
    assert tables[0] == tables[1] == [(1, "x"), (2, "b"), (2, "second"), (3, "c"), (3, "third")]


def test_late_changes_resolve_by_version(spark, scratch, t):
    changes = t.order_changes
    st = TableStore(spark, scratch + "/late")
    sync_snapshot(st, spark.createDataFrame([], t.orders.schema), "orders", keys=KEYS, source_version=-1)
    st.append_changes(changes.filter("_commit_version > 40"), "orders")
    st.append_changes(changes.filter("_commit_version <= 40"), "orders")  # late, older changes
    assert _rows(st.read("orders")) == _rows(V.state_at_version(changes, KEYS, 10 ** 6))


def test_added_columns_are_kept_others_raise(spark, scratch):
    st = _small(spark, scratch)
    wide = _feed(spark, (1, "x", "update_postimage", 5)).selectExpr("*", "7 AS extra")
    assert sync_triggered(st, wide, "t") is not None
    assert _rows(st.read("t").select("id", "v", "extra").fillna(0)) == [(1, "x", 7), (2, "b", 0)]
    assert st.read("t", 0).columns == ["id", "v"]
    with pytest.raises(ValueError, match="dropped"):
        sync_triggered(st, _feed(spark, (1, "x", "insert", 9)).drop("v"), "t")
    with pytest.raises(ValueError, match="retyped"):
        sync_triggered(st, _feed(spark, (1, "1", "insert", 9)).withColumn("v", F.lit(1)), "t")


def test_changes_without_keys_are_refused_when_written(spark, scratch):
    st = TableStore(spark, scratch + "/nokeys")
    st.overwrite(spark.createDataFrame([(1, "a")], SMALL), "t", source_version=1)
    with pytest.raises(ValueError, match="keys"):
        sync_triggered(st, _feed(spark, (1, "x", "insert", 5)), "t")


def test_new_checkpoint_skips_nothing(spark, scratch):
    st = _small(spark, scratch)
    for name, rows in (("a", [(3, "c", "insert", 2)]), ("b", [(4, "d", "insert", 3)])):
        _feed(spark, *rows).write.parquet(f"{scratch}/feed-{name}")
        stream = spark.readStream.schema(FEED).parquet(f"{scratch}/feed-{name}")
        sync_continuous(stream, st, "t", f"{scratch}/ckpt-{name}").awaitTermination()
    assert _rows(st.read("t")) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_read_without_changes_moves_nothing(spark, scratch):
    st = _small(spark, scratch)
    assert "Exchange" not in st.read("t")._jdf.queryExecution().toString()


def test_eleventh_manual_snapshot_is_refused_and_expiry_keeps_the_ten(spark, scratch):
    import datetime as dt
    from emporia.sources.store import SnapshotLimitError
    st = _small(spark, scratch)
    old = dt.datetime(2020, 1, 1)
    for i in range(10):
        st.snapshot("t", f"m{i}", at=old)
    st.snapshot("t", "s", kind="scheduled", at=old)
    with pytest.raises(SnapshotLimitError):
        st.snapshot("t", "one too many")
    left = V.expire_snapshots(st.versions("t"), "2024-01-01 00:00:00").collect()
    assert sorted(r.kind for r in left) == ["overwrite"] + ["snapshot:manual"] * 10


def test_a_damaged_pointer_raises(spark, scratch):
    import os
    st = _small(spark, scratch)
    with open(scratch + "/small/t/_versions/part-broken.snappy.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        st.latest_version("t")
    assert os.path.exists(scratch + "/small/t/_versions")
    assert TableStore(spark, scratch + "/small").latest_version("unknown") is None
