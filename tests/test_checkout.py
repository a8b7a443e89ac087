"""Checkout and allocation against a cart-by-cart brute force, with contested stock."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emporia.functions.windows import running_sum
from emporia.operators import cart as H

T0 = datetime(2024, 1, 1)


def one_by_one(lines, stock):
    """lines: (unit, resource, quantity, order) -> accepted units, taken in order."""
    left, units, accepted = dict(stock), {}, set()
    for unit, resource, q, order in lines:
        units.setdefault((order, unit), []).append((resource, q))
    for (_, unit), parts in sorted(units.items()):
        if all(r in left and left[r] >= q for r, q in parts):
            accepted.add(unit)
            for r, q in parts:
                left[r] -= q
    return accepted, left


def frame(spark, lines, stock):
    return spark.createDataFrame([(u, r, q, T0 + timedelta(seconds=o), stock.get(r)) for u, r, q, o in lines],
                                 "customer_id long, product_id long, quantity long, ts timestamp_ntz, stock long")


@pytest.mark.parametrize("seed", range(4))
def test_acceptance_equals_one_by_one(spark, seed):
    rng = random.Random(seed)
    stock = {p: rng.choice([0, 3, 10, 10, 400]) for p in range(8)}
    lines = []
    for c in range(120):
        for p in rng.sample(range(9), rng.randint(1, 4)):  # product 8 is unknown
            lines.append((c, p, rng.randint(1, 6), c * 7 % 40))  # ties in time go to the smaller customer
    want, _ = one_by_one(lines, stock)
    got = H.accept_in_order(frame(spark, lines, stock), ["customer_id"], "product_id", ["ts", "customer_id"]).collect()
    assert {r.customer_id for r in got if r.accepted} == want
    assert len(got) == len(lines) and {r.customer_id for r in got if not r.accepted} == set(range(120)) - want
    sold = {p: sum(r.quantity for r in got if r.accepted and r.product_id == p) for p in stock}
    assert all(sold[p] <= stock[p] for p in stock)


def retail(spark, carts, stock):
    """A tables dict and a timed cart: carts = [(customer, product, quantity, second)]."""
    products = spark.createDataFrame([(p, f"p{p}", "c") for p in stock], "id long, name string, category string").withColumn(
        "price", F.lit("10.50").cast("decimal(18,2)"))
    inventory = spark.createDataFrame([(p * 10, p, "US", q, 5, 0) for p, q in stock.items()] ,
                                      "id long, product_id long, warehouse string, quantity int, reorder_level int, reserved int")
    orders = spark.createDataFrame([(100,)], "id long")
    cart = spark.createDataFrame([(c, p, q, T0 + timedelta(seconds=s)) for c, p, q, s in carts],
                                 "customer_id long, product_id long, quantity long, ts timestamp_ntz")
    return {"products": products, "inventory": inventory, "orders": orders,
            "order_items": spark.createDataFrame([(7,), (8,)], "id long")}, cart


def test_two_carts_of_six_on_stock_ten(spark):
    t, cart = retail(spark, [(1, 1, 6, 0), (2, 1, 6, 1)], {1: 10})
    out = H.checkout(cart, t, None, "2024-02-01 00:00:00")
    assert [(r.id, r.customer_id, r.quantity) for r in out["orders"].collect()] == [(101, 1, 6)]
    assert [r.quantity for r in out["inventory"].collect()] == [4]
    assert [(r.customer_id, r.points) for r in out["points"].collect()] == [(1, 60)]
    assert [(r.id, r.order_id) for r in out["order_items"].collect()] == [(9, 101)]  # after the largest item id


def test_twelve_then_five_on_stock_ten(spark):
    t, cart = retail(spark, [(1, 1, 12, 0), (2, 1, 5, 1)], {1: 10})
    got = {r.customer_id: (r.granted, r.remaining) for r in H.allocate_stock(cart, t["inventory"]).collect()}
    assert got == {1: (False, 10), 2: (True, 10)}
    assert [r.customer_id for r in H.checkout(cart, t, None, "2024-02-01 00:00:00")["orders"].collect()] == [2]


def test_a_refused_cart_uses_nothing_and_unknown_products_refuse(spark):
    t, cart = retail(spark, [(1, 1, 6, 0), (1, 2, 3, 0), (2, 1, 8, 1), (3, 9, 1, 2), (3, 2, 1, 2)], {1: 10, 2: 1})
    out = H.checkout(cart, t, None, "2024-02-01 00:00:00")
    assert {r.customer_id for r in out["orders"].collect()} == {2}
    assert {r.product_id: r.quantity for r in out["inventory"].collect()} == {1: 2, 2: 1}


def test_second_warehouse_skips_what_it_cannot_serve(spark):
    t, _ = retail(spark, [], {1: 10})
    inventory = spark.createDataFrame([(1, 1, "A", 4, 1, 0), (2, 1, "B", 20, 1, 0)], t["inventory"].schema)
    demand = spark.createDataFrame([(1, 3, 1), (1, 3, 2), (1, 1, 3)], "product_id long, quantity long, customer_id long")
    got = {r.id: r.quantity for r in H.conditional_decrement(inventory, demand).collect()}
    assert got == {1: 0, 2: 13}  # A: 4-3, skips 3, 1-1


def test_hot_product_sold_out(spark):
    lines = [(c, 1, 1 + c % 3, c // 100) for c in range(3000)]
    want, left = one_by_one(lines, {1: 700})
    got = H.accept_in_order(frame(spark, lines, {1: 700}), ["customer_id"], "product_id", ["ts", "customer_id"])
    assert {r.customer_id for r in got.filter("accepted").collect()} == want and left[1] == 0


def test_running_sum_equals_the_window(spark):
    from pyspark.sql import Window
    df = spark.range(2000).selectExpr("IF(id % 3 = 0, 0, id % 7) AS k", "id * 37 % 500 AS o", "id % 11 AS v")
    w = Window.partitionBy("k").orderBy("o")
    want = sorted(map(tuple, df.withColumn("s", F.sum("v").over(w)).select("k", "o", "v", "s").collect()))
    got = sorted(map(tuple, running_sum(df, ["k"], ["o"], {"s": F.col("v")}).select("k", "o", "v", "s").collect()))
    assert got == want


def test_checkout_keys_never_oversell(spark, sf_dir):
    import __spark_entry__ as E
    after = E.queries()["checkout_inventory"](spark, sf_dir)
    assert after.filter("quantity < 0").count() == 0


@pytest.mark.parametrize("n", [5000])
def test_a_chain_of_ten_thousand_lines_takes_few_rounds(spark, n):
    # 1, s, 1, s-1, ...: every line waits for the one before it.
    lines = [x for i in range(n) for x in ((2 * i, 1, 1, 2 * i), (2 * i + 1, 1, n - i, 2 * i + 1))]
    want, _ = one_by_one(lines, {1: n})
    trace = []
    got = H.accept_in_order(frame(spark, lines, {1: n}), ["customer_id"], "product_id", ["ts", "customer_id"], trace).collect()
    assert {r.customer_id for r in got if r.accepted} == want and len(got) == len(lines)
    assert len(trace) <= 25, trace


@pytest.mark.parametrize("seed", range(4))
def test_halving_of_single_lines_equals_one_by_one(spark, seed):
    from emporia.functions.windows import by_ranges
    from emporia.operators.first_come import halve
    rng = random.Random(seed)
    stock = {p: rng.choice([0, 1, 2, 63, 64, 65, 5000]) for p in range(12)}
    lines = [(c, rng.randrange(12), rng.choice([0, 1, 1, 2, 30, 33, 64, 2500, 2501]), rng.randrange(50)) for c in range(900)]
    want, _ = one_by_one(lines, stock)
    trace = []
    ranged = by_ranges(frame(spark, lines, stock), ["product_id"], ["ts", "customer_id"])
    assert {r.customer_id for r in halve(ranged, "product_id", ["ts", "customer_id"], trace).collect()} == want
    assert len(trace) <= 5000 .bit_length() + 2


@pytest.mark.parametrize("seed", range(3))
def test_carts_over_several_contested_products(spark, seed):
    rng = random.Random(seed)
    stock = {p: rng.randint(50, 900) for p in range(10)}
    lines = [(c, p, rng.choice([1, 5, 200, 300]), c // 3) for c in range(250) for p in rng.sample(range(10), rng.choice([1, 1, 1, 2, 3]))]
    want, _ = one_by_one(lines, stock)
    trace = []
    got = H.accept_in_order(frame(spark, lines, stock), ["customer_id"], "product_id", ["ts", "customer_id"], trace).collect()
    assert {r.customer_id for r in got if r.accepted} == want
    assert trace[0][0] == "bounds" and len(trace) <= 40


def test_null_customers_ties_and_empty_carts(spark):
    lines = [(None, 1, 6, 0), (1, 1, 6, 0), (2, 1, 3, 0), (3, 1, 1, 0)]  # same time: null first, then by customer
    got = {r.customer_id: r.accepted for r in
           H.accept_in_order(frame(spark, lines, {1: 10}), ["customer_id"], "product_id", ["ts"]).collect()}
    assert got == {None: True, 1: False, 2: True, 3: True}
    assert H.accept_in_order(frame(spark, lines, {}).limit(0), ["customer_id"], "product_id", ["ts"]).count() == 0
