"""Edge rows on small hand-written frames (FIXTURES.md section 4).

Where the reference's own SQL defines the answer, the same SQL runs in DuckDB
on the same rows and the Spark operator must agree.
"""

import datetime as dt
import random
from decimal import Decimal as D

import duckdb
import pytest

from emporia.functions import scalars as S
from emporia.operators import activity as A
from emporia.operators import cart as H
from emporia.operators import catalog as C
from emporia.operators import checks as K
from emporia.operators import loyalty as L
from emporia.operators import orders as O
from emporia.operators import promos as P
from emporia.operators import sync as Y
from emporia.operators import versions as V

TS = dt.datetime(2024, 1, 1)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def shop(spark):
    products = spark.createDataFrame(
        [(1, "alpha lamp", D("10.50"), "Home"), (2, "beta chair", D("99.99"), None),
         (3, "gamma desk", D("250.00"), "Home"), (4, "delta mug", D("5.00"), "Kitchen"),
         (5, "eps vase", D("12.00"), "Home")],
        "id long, name string, price decimal(18,2), category string")
    inventory = spark.createDataFrame(
        [(10, 1, "US-EAST", 5, 10, 0), (11, 2, "US-EAST", 7, 5, 1), (12, 2, "EU-WEST", 3, 5, 0),
         (13, 3, "US-EAST", 4, 5, 0), (14, 3, "APAC", 4, 5, 0), (15, 5, "US-EAST", 0, 5, 0)],
        "id long, product_id long, warehouse string, quantity int, reorder_level int, reserved int")
    reviews = spark.createDataFrame(
        [(1, 100, 5, TS), (1, 101, 4, TS), (2, 100, 3, TS), (3, 102, 1, TS), (3, 103, 2, TS), (3, 104, 2, TS)],
        "product_id long, customer_id long, rating int, review_date timestamp_ntz")
    items = spark.createDataFrame(
        [(1, 1, 2, D("10.50"), D("21.00")), (2, 2, 1, D("99.99"), D("99.99")), (3, 3, 3, D("250.00"), D("750.00")),
         (4, 1, 1, D("10.50"), D("10.50")), (5, 4, 9, D("5.00"), D("45.00"))],
        "order_id long, product_id long, quantity int, unit_price decimal(18,2), line_total decimal(18,2)")
    return {"products": products, "inventory": inventory, "reviews": reviews, "order_items": items}


def _duck(shop):
    con = duckdb.connect()
    for k, v in shop.items():
        con.register(k, v.toPandas())
    return con


def test_catalog_listing_fanout_matches_reference_sql(spark, shop):
    got = C.catalog_listing(shop, limit=None).select("id", "stock", "avg_rating", "review_count")
    con = _duck(shop)
    want = con.execute("""
        SELECT p.id, COALESCE(i.quantity, 0) AS stock, COALESCE(ROUND(AVG(r.rating), 1), 0) AS avg_rating,
               COUNT(r.rating) AS review_count
        FROM products p LEFT JOIN inventory i ON i.product_id = p.id LEFT JOIN reviews r ON r.product_id = p.id
        GROUP BY p.id, p.name, p.price, p.category, i.quantity""").fetchall()
    assert [(a, b, float(c), d) for a, b, c, d in _rows(got)] == sorted((a, b, float(c), d) for a, b, c, d in want)


def test_best_sellers_exact_matches_reference_sql(spark, shop):
    got = C.best_sellers(shop, 8, "exact").select("id", "stock", "units_sold")
    con = _duck(shop)
    want = con.execute("""
        SELECT p.id, COALESCE(inv.quantity, 0) AS stock, SUM(oi.quantity) AS units_sold
        FROM order_items oi JOIN products p ON p.id = oi.product_id
        LEFT JOIN inventory inv ON inv.product_id = p.id LEFT JOIN reviews r ON r.product_id = p.id
        GROUP BY p.id, p.name, p.price, p.category, inv.quantity""").fetchall()
    assert _rows(got) == sorted((a, b, int(c)) for a, b, c in want)


def test_best_sellers_correct_mode_does_not_multiply(spark, shop):
    got = {r.id: r.units_sold for r in C.best_sellers(shop, 8, "correct").collect()}
    assert got == {1: 3, 2: 1, 3: 3, 4: 9}


def test_top_rated_having_two(spark, shop):
    got = _rows(C.top_rated(shop, 2, 8).select("id", "avg_rating", "review_count"))
    # product 1: 2 reviews avg 4.5; product 3: 3 reviews x 2 equal-quantity rows -> count 6, avg 1.7
    assert got == [(1, D("4.5"), 2), (3, D("1.7"), 6)]


def test_null_category_kept_in_distinct_not_counted(spark, shop):
    cats = [r.category for r in C.distinct_values(shop["products"], "category").collect()]
    assert cats == ["Home", "Kitchen", None]
    c = C.catalog_counts(shop).collect()[0]
    assert (c.total_products, c.total_categories) == (5, 2)


def test_catalog_filter_does_not_escape_wildcards(spark, shop):
    assert C.catalog_filter(shop["products"], search="%").count() == 5
    assert C.catalog_filter(shop["products"], search="_").count() == 5
    assert C.catalog_filter(shop["products"], "Home", "LAMP").count() == 1


def test_catalog_page_bounds(spark, shop):
    with pytest.raises(ValueError):
        C.catalog_page(shop["products"], 0)
    assert [r.id for r in C.catalog_page(shop["products"], 2, 1).collect()] == [2, 3]


def test_priority_and_tier_bounds(spark):
    df = spark.createDataFrame([(1, D(x)) for x in ["200.00", "200.01", "500.00", "500.01"]],
                               "id long, total decimal(18,2)")
    assert [r.priority for r in O.order_priority(df).orderBy("total").collect()] == \
        ["normal", "medium", "medium", "high"]
    pts = spark.createDataFrame([(i, "c%d@x" % i, p) for i, p in enumerate([0, 499, 500, 1499, 1500, 2999, 3000])],
                                "id long, email string, loyalty_points long")
    m = L.enroll_members(pts, "2024-01-01 00:00:00")
    assert sorted((r.total_earned, r.tier) for r in m.collect()) == [
        (499, "Bronze"), (500, "Silver"), (1499, "Silver"), (1500, "Gold"), (2999, "Gold"), (3000, "Platinum")]


def test_enroll_exact_mode_duplicates_on_replay(spark):
    pts = spark.createDataFrame([(1, "a@x", 10)], "id long, email string, loyalty_points long")
    first = L.enroll_members(pts, "2024-01-01 00:00:00")
    assert L.enroll_members(pts, "2024-01-01 00:00:00", existing=first).count() == 1
    assert L.enroll_members(pts, "2024-01-01 00:00:00", existing=first, exact=True).count() == 2


def test_email_verified_id_mod_3(spark):
    df = O.email_verified(spark.range(1, 7))
    assert [r.email_verified for r in df.orderBy("id").collect()] == [False, False, True, False, False, True]


def test_loyalty_points_zero_for_customer_without_orders(spark):
    t = {"customers": spark.createDataFrame([(1,), (2,)], "id long"),
         "orders": spark.createDataFrame([(1, D("10.90")), (1, D("5.10"))], "customer_id long, total decimal(18,2)")}
    assert _rows(L.loyalty_points(t)) == [(1, 15), (2, 0)]


@pytest.fixture()
def promos(spark):
    return spark.createDataFrame(
        [(1, 1, "A", D("10.00"), D("9.45"), "percentage", True, TS, TS),
         (2, 1, "B", D("20.00"), D("8.40"), "percentage", True, TS, TS),
         (3, 2, "C", D("30.00"), None, "percentage", True, TS, TS),
         (4, 4, "D", D("50.00"), D("0.00"), "percentage", True, TS, TS),
         (5, 3, "E", D("40.00"), D("150.00"), "percentage", False, TS, TS)],
        "id long, product_id long, badge_text string, discount_pct decimal(5,2), sale_price decimal(10,2), "
        "promo_type string, is_active boolean, start_date timestamp_ntz, end_date timestamp_ntz")


def test_promo_overlay_greatest_id_wins(spark, shop, promos):
    got = {r.id: r.badge_text for r in P.promo_overlay(shop["products"], promos).collect()}
    assert got == {1: "B", 2: "C", 3: None, 4: "D", 5: None}


def test_promo_deals_two_promos_appear_twice(spark, shop, promos):
    t = dict(shop, promotions=promos)
    ids = [r.id for r in P.promo_deals(t, 8).collect()]
    assert ids.count(1) == 2 and 3 not in ids


def test_price_cart_sale_price_zero_or_null_falls_back(spark, shop, promos):
    t = dict(shop, promotions=promos)
    cart = spark.createDataFrame([(7, 1, 2), (7, 2, 1), (7, 4, 3), (7, 99, 5)],
                                 "customer_id long, product_id long, quantity long")
    priced = {r.product_id: r for r in H.price_cart(cart, t).collect()}
    assert set(priced) == {1, 2, 4}  # unknown product skipped
    assert priced[1].effective_price == D("8.40") and priced[1].line_total == D("16.80")
    assert priced[2].effective_price == D("99.99")  # NULL sale price
    assert priced[4].effective_price == D("5.00")  # zero sale price
    assert priced[1].loyalty_points_earned == 16
    tot = H.cart_totals(cart, H.price_cart(cart, t), t).collect()[0]
    assert tot.item_count == 11  # unknown product still counted
    assert tot.subtotal == D("16.80") + D("99.99") + D("15.00")


def test_promo_sale_price_missing_price_is_null(spark, promos, shop):
    out = {r.id: r.sale_price for r in P.promo_sale_price(promos, shop["products"]).collect()}
    assert out[1] == D("9.45") and out[5] == D("150.00")
    assert P.promo_sale_price(promos, shop["products"].filter("id = 2")).filter("id = 1").collect()[0].sale_price is None


def _fold(events, known):
    """Sequential reference semantics of the in-process cart."""
    carts = {}
    for e in sorted(events, key=lambda e: (e[2], e[0])):
        eid, cid, ts, action, pid, qty = e
        cart = carts.setdefault(cid, {})
        if action == "clear":
            carts[cid] = {}
        elif action == "add":
            if qty is not None and qty >= 1 and pid in known:
                cart[pid] = cart.get(pid, 0) + qty
        elif action == "update":
            if pid in cart:
                if (qty or 0) <= 0:
                    del cart[pid]
                else:
                    cart[pid] = qty
    return sorted((c, p, q) for c, cart in carts.items() for p, q in cart.items())


EV_SCHEMA = "event_id long, customer_id long, ts timestamp_ntz, action string, product_id long, quantity int"


def test_cart_state_rules(spark, shop):
    t0 = TS
    ev = [(1, 1, t0, "add", 1, 0),            # qty 0 rejected
          (2, 1, t0, "update", 2, 5),          # absent item: ignored
          (3, 1, t0, "add", 2, 2),
          (4, 1, t0, "update", 2, 0),          # removes
          (5, 1, t0, "add", 3, 1),
          (6, 1, t0, "clear", None, None),
          (7, 1, t0, "add", 4, 3),             # after clear
          (8, 1, t0, "add", 99, 3),            # unknown product
          (9, 2, t0, "add", 1, 2), (10, 2, t0, "update", 1, 7), (11, 2, t0, "add", 1, 1)]
    df = spark.createDataFrame(ev, EV_SCHEMA)
    got = _rows(H.cart_state(df, shop["products"]))
    assert got == [(1, 4, 3), (2, 1, 8)]
    assert got == _fold(ev, {1, 2, 3, 4, 5})


@pytest.mark.parametrize("seed", range(6))
def test_cart_state_equals_sequential_fold(spark, shop, seed):
    rnd = random.Random(seed)
    ev = []
    for i in range(400):
        action = rnd.choice(["add", "add", "update", "update", "clear"])
        ev.append((i, rnd.randint(1, 3), TS + dt.timedelta(seconds=rnd.randint(0, 60)), action,
                   None if action == "clear" else rnd.randint(1, 6),
                   None if action == "clear" or rnd.random() < 0.05 else rnd.randint(-1, 4)))
    df = spark.createDataFrame(ev, EV_SCHEMA)
    assert _rows(H.cart_state(df, shop["products"])) == _fold(ev, {1, 2, 3, 4, 5})


def test_validate_and_checkout(spark, shop, promos):
    t = dict(shop, promotions=promos, orders=spark.createDataFrame([(41, 1)], "id long, customer_id long"))
    cart = spark.createDataFrame([(1, 1, 2), (2, 1, 9), (3, 99, 1)], "customer_id long, product_id long, quantity long")
    shoppers = spark.createDataFrame([(1,), (2,), (3,), (4,)], "customer_id long")
    v = {r.customer_id: (r.status, r.reason) for r in H.validate_checkout(cart, t, shoppers).collect()}
    assert v == {1: ("ok", None), 2: ("rejected", "not enough stock"), 3: ("rejected", "product not found"),
                 4: ("empty", "cart is empty")}
    out = H.checkout(cart, t, shoppers, "2024-02-01 00:00:00")
    o = out["orders"].collect()
    assert [(r.id, r.customer_id, r.total, r.status, r.currency) for r in o] == [(42, 1, D("21.00"), "pending", "USD")]
    inv = {r.id: r.quantity for r in out["inventory"].collect()}
    assert inv[10] == 3
    assert {r.customer_id: r.points for r in out["points"].collect()} == {1: 20}


def test_conditional_decrement_hits_every_warehouse_row(spark, shop):
    demand = spark.createDataFrame([(3, 4), (2, 5)], "product_id long, quantity long")
    inv = {r.id: r.quantity for r in H.conditional_decrement(shop["inventory"], demand).collect()}
    assert inv[13] == 0 and inv[14] == 0  # both rows of product 3 had 4 >= 4
    assert inv[11] == 2 and inv[12] == 3  # 3 < 5 untouched


def test_allocate_stock_first_come(spark, shop):
    cart = spark.createDataFrame(
        [(1, 1, 3, TS), (2, 1, 3, TS + dt.timedelta(minutes=1)), (3, 1, 1, TS + dt.timedelta(hours=2))],
        "customer_id long, product_id long, quantity long, ts timestamp_ntz")
    got = [(r.customer_id, r.remaining, r.granted)
           for r in H.allocate_stock(cart, shop["inventory"]).orderBy("customer_id").collect()]
    assert got == [(1, 5, True), (2, 2, False), (3, 2, True)]  # a refused line uses nothing


CH_SCHEMA = ("id long, v string, _change_type string, _commit_version long, "
             "_commit_ts timestamp_ntz, _seq int")


def _ch(spark, rows):
    return spark.createDataFrame(rows, CH_SCHEMA)


def test_change_feed_ordering(spark):
    c = _ch(spark, [
        (2, "b2", "update_postimage", 2, TS, 1),
        (1, "a1", "insert", 1, TS, 0),
        (2, "b1", "insert", 2, TS, 0),          # same key twice in one version: seq decides
        (3, "c1", "insert", 1, TS, 0),
        (3, None, "delete", 2, TS, 0),
        (3, "c2", "insert", 3, TS, 0),          # delete then re-insert
        (1, "a0", "update_preimage", 2, TS, 0),  # pre-images ignored
    ])
    assert _rows(V.state_at_version(c, ["id"], 3)) == [(1, "a1"), (2, "b2"), (3, "c2")]
    assert _rows(V.state_at_version(c, ["id"], 2)) == [(1, "a1"), (2, "b2")]
    target = spark.createDataFrame([(1, "a1"), (3, "c1")], "id long, v string")
    once = Y.upsert(target, c.filter("_commit_version >= 2"), ["id"])
    twice = Y.upsert(once, c.filter("_commit_version >= 2"), ["id"])
    assert _rows(once) == _rows(twice) == [(1, "a1"), (2, "b2"), (3, "c2")]


def test_as_of_before_window_raises(spark):
    c = _ch(spark, [(1, "a", "insert", 1, TS, 0)])
    with pytest.raises(V.RestoreWindowError):
        V.as_of(c, ["id"], "2023-01-01 00:00:00", now="2024-01-15 00:00:00")
    assert V.as_of(c, ["id"], "2024-01-02 00:00:00", now="2024-01-15 00:00:00").count() == 1


def test_row_diff_kinds_and_self(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id long, v string")
    b = spark.createDataFrame([(2, "y2"), (3, None), (4, "z")], "id long, v string")
    assert V.row_diff(a, a, ["id"]).count() == 0
    assert _rows(V.row_diff(a, b, ["id"])) == [(1, "removed"), (2, "changed"), (4, "added")]


def test_schema_diff_reports_drift(spark):
    a = spark.createDataFrame([(1, "n", 1)], "id long, name string, x int")
    b = spark.createDataFrame([(1, "n", 1.0, True)], "id long, name string, x double, email_verified boolean")
    got = {r.column_name: r.change for r in V.schema_diff(a, b).collect()}
    assert got == {"x": "type_changed", "email_verified": "only_in_b"}
    with pytest.raises(ValueError):
        Y.additive_schema_sync(b, a)
    assert Y.additive_schema_sync(a.drop("x"), a).columns == ["id", "name", "x"]


def test_expire_snapshots_keeps_manual_ones_and_other_versions(spark):
    rows = [("t", i, TS + dt.timedelta(days=i), "snapshot:manual") for i in range(12)] + \
           [("t", 100 + i, TS + dt.timedelta(days=i * 10), "snapshot:scheduled") for i in range(5)] + \
           [("t", 200, TS, "overwrite"), ("t", 201, TS, "changes")]
    m = spark.createDataFrame(rows, "table_name string, version long, created_at timestamp_ntz, kind string")
    kept = V.expire_snapshots(m, TS + dt.timedelta(days=45), 30)
    vs = sorted(r.version for r in kept.collect())
    assert vs == list(range(12)) + [102, 103, 104, 200, 201]


def test_row_diff_over_a_schema_change(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "id long, v string, gone int")
    b = spark.createDataFrame([(1, "x", 7), (2, "z", 8)], "id long, v string, new int")
    assert _rows(V.row_diff(a, b, ["id"])) == [(2, "changed")]
    assert _rows(V.row_diff(a.select("id"), b.select("id"), ["id"])) == []
    assert {r.column_name for r in V.schema_diff(a, b).collect()} == {"gone", "new"}


def test_schema_profile_covers_both_sides(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "x", None)], "id long, old string, n int")
    b = spark.createDataFrame([(1, 5.0), (2, None)], "id long, n double")
    got = {r.column_name: (r.null_count, r.distinct_count) for r in V.schema_diff(a, b, profile=True).collect()}
    assert got == {"old": (0, 1), "n": (1, 1)}


def test_sync_verify_sees_stale_values(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id long, v string")
    b = spark.createDataFrame([(1, "old"), (2, None), (4, "w")], "id long, v string")
    assert _rows(Y.sync_verify(a, b, ["id"])) == [(3, 3, 1, 1, 1)]


def test_empty_target_takes_a_snapshot(spark):
    ch = spark.createDataFrame([(1, "insert", 5)], "id long, _change_type string, _commit_version long")
    r = Y.choose_sync_mode(Y.changed_ratio(ch, 0, ["id"], 0)).collect()[0]
    assert r["mode"] == "snapshot"


def test_upsert_keeps_nulls_and_reads_the_feed_once(spark, scratch):
    target = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "id long, v string")
    rows = [(2, None, "update_postimage", 2, 0), (3, "x", "update_postimage", 1, 0), (3, None, "delete", 2, 0),
            (4, "n", "insert", 1, 0), (4, "m", "update_postimage", 1, 1)]
    spark.createDataFrame(rows, "id long, v string, _change_type string, _commit_version long, _seq int").write.parquet(scratch + "/f")
    feed = spark.read.parquet(scratch + "/f")
    out = Y.upsert(target, feed, ["id"])
    assert sorted(map(tuple, out.collect())) == [(1, None), (2, None), (4, "m")]
    plan = Y.upsert(target, feed, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "SortAggregate" not in plan


def test_insert_if_absent_first_row_wins_existing_kept(spark):
    target = spark.createDataFrame([(1, "old")], "id long, v string")
    rows = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "id long, v string")
    assert _rows(Y.insert_if_absent(target, rows, ["id"], order=["v"])) == [(1, "old"), (2, "a")]


def test_checks_null_semantics(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id long, parent long")
    parent = spark.createDataFrame([(10,)], "id long")
    assert _rows(K.check_foreign_key(child, ["parent"], parent, ["id"])) == [(3, 99)]
    assert _rows(K.cascade_delete(child, ["parent"], parent, ["id"])) == [(1, 10), (2, None)]
    dom = spark.createDataFrame([(1, 0), (2, None), (3, 6)], "id long, rating int")
    assert _rows(K.check_domain(dom, "rating", low=1, high=5)) == [(1, 0), (3, 6)]
    nn = K.check_not_null(child, ["parent"]).collect()
    assert [(r.id, r.null_columns) for r in nn] == [(2, ["parent"])]


def test_strip_null_bytes_nested_and_type_map(spark):
    df = spark.createDataFrame(
        [(1, "a\u0000b", ["x\u0000"], {"k": "v\u0000"}, ("s\u0000",))],
        "id int, t string, arr array<string>, m map<string,string>, st struct<f:string>")
    r = Y.strip_null_bytes(df).collect()[0]
    assert (r.t, r.arr, r.m, r.st.f) == ("ab", ["x"], {"k": "v"}, "s")
    out, rep = Y.map_types_for_sync(df)
    o = out.collect()[0]
    assert o.arr == '["x"]' and o.m == '{"k":"v"}' and o.st == '{"f":"s"}'
    types = {r.column: r.target_type for r in rep.collect()}
    assert types["arr"] == "JSONB" and types["id"] == "INTEGER"
    ts = spark.createDataFrame([(TS,)], "t timestamp_ntz")
    assert Y.map_types_for_sync(ts)[1].collect()[0].target_type == "TIMESTAMP WITHOUT TIME ZONE"
    assert Y.map_types_for_sync(ts, Y.REFERENCE_TYPE_MAP)[1].collect()[0].target_type == "TIMESTAMP WITH TIME ZONE"
    bad = spark.createDataFrame([(1, 1.0)], "a int, b double").selectExpr("a", "parse_json('1') AS v")
    with pytest.raises(Y.UnsupportedTypeError, match="v"):
        Y.map_types_for_sync(bad)
    b = Y.string_to_binary(df.select("t"), ["t"]).collect()[0].t
    assert bytes(b) == b"a\x00b"


def test_keyed_ctas_null_part_gives_null_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y int")
    keys = [r.row_key for r in Y.keyed_ctas(df, ["x", "y"]).orderBy("y").collect()]
    assert keys[0] is not None and keys[1] is None


def test_normalise_query_numbers_literals():
    import pandas as pd  # noqa: F401
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([("SELECT * FROM t1 WHERE a = 'x''y' AND b = 12.5 AND c = 3",), ("SELECT 1",)], "q string")
    got = [r.n for r in df.select(A.normalise_query_col("q").alias("n")).collect()]
    assert got == ["SELECT * FROM t1 WHERE a = $1 AND b = $2 AND c = $3", "SELECT $1"]


def test_safe_identifier(spark):
    df = spark.createDataFrame([("  John.Doe@Example.com ",), ("___",)], "s string")
    assert [r.x for r in df.select(S.safe_identifier("s").alias("x")).collect()] == ["john_doe_example_com", "user"]


def test_half_up_rounding_exact(spark):
    df = spark.createDataFrame([(1, 3), (2, 8), (1, 8), (5, 2)], "n long, d long")
    got = [r.x for r in df.select(S.half_up_div("n", "d", 2).alias("x")).collect()]
    assert got == [D("0.33"), D("0.25"), D("0.13"), D("2.50")]
