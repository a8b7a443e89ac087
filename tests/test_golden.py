"""Golden checks from the reference's own seed rows and self-checks.

The literal rows below are fixed values copied as data (they are the
reference's seed inputs); prices there are random, so only counts and
discounts are golden, not sale prices.
"""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from emporia.operators import catalog as C
from emporia.operators import promos as P
from emporia.operators import sync as Y
from emporia.sources.store import TableStore, sync_snapshot, sync_triggered

# ---------------------------------------------------------------------------
# Seed promotions (id, product_id, badge_text, discount_pct).
SEED_PROMOS = [
    (1, 1, "SPRING SALE", "20.00"), (2, 2, "HOT DEAL", "30.00"), (3, 6, "SPRING SALE", "15.00"),
    (4, 11, "CLEARANCE", "40.00"), (5, 14, "SPRING SALE", "25.00"), (6, 21, "LIMITED TIME", "10.00"),
    (7, 23, "SPRING SALE", "20.00"), (8, 31, "FLASH SALE", "35.00"), (9, 33, "SPRING SALE", "15.00"),
    (10, 41, "HOT DEAL", "25.00"), (11, 45, "SPRING SALE", "20.00"), (12, 50, "CLEARANCE", "50.00"),
]
# Promotions added later.
NEW_PROMOS = [(13, 3, "FLASH SALE", "45.00"), (14, 7, "FLASH SALE", "35.00"), (15, 35, "MEGA DEAL", "60.00")]
# Two-warehouse stock (product_id, warehouse, quantity, reserved).
INVENTORY_MAIN = [
    (1, "US-EAST", 45, 5), (1, "US-WEST", 30, 2), (2, "US-EAST", 180, 15), (2, "EU-WEST", 95, 8),
    (3, "US-EAST", 25, 3), (4, "US-EAST", 70, 10), (4, "EU-WEST", 55, 6), (5, "US-EAST", 120, 20),
    (6, "US-EAST", 200, 0), (6, "APAC", 150, 5), (7, "US-EAST", 90, 0), (8, "US-EAST", 60, 4),
    (9, "US-EAST", 110, 8), (10, "US-EAST", 40, 10), (10, "EU-WEST", 35, 5), (11, "US-EAST", 100, 0),
    (12, "US-EAST", 250, 0), (13, "EU-WEST", 80, 3), (14, "EU-WEST", 65, 7), (15, "US-EAST", 130, 0),
]
# ---------------------------------------------------------------------------

PROMO_SCHEMA = ("id long, product_id long, badge_text string, discount_pct decimal(5,2), sale_price decimal(10,2), "
                "promo_type string, is_active boolean, start_date timestamp_ntz, end_date timestamp_ntz")
NOW = dt.datetime(2024, 3, 1)


def _promos(spark, rows):
    return spark.createDataFrame(
        [(i, p, b, D(d), None, "percentage", True, NOW, NOW + dt.timedelta(days=14)) for i, p, b, d in rows],
        PROMO_SCHEMA)


def test_promotions_resync_golden(spark, scratch):
    prices = spark.range(1, 51).select(F.col("id"), (F.col("id") * 10 + F.lit(D("0.99"))).cast("decimal(18,2)").alias("price"))
    seeded = P.promo_sale_price(_promos(spark, SEED_PROMOS), prices)
    assert P.active_promos(seeded).count() == 12
    added = P.promo_sale_price(_promos(spark, NEW_PROMOS), prices)
    updated = P.reprice_promo(Y.insert_select(seeded, added), 1)
    rows = {r.id: r for r in updated.collect()}
    assert P.active_promos(updated).count() == 15
    assert rows[1].discount_pct == D("35.00") and rows[1].badge_text == "MEGA DEAL"
    # sale price rescaled from the 20% price: round(s / 0.8 * 0.65, 2)
    s20 = [r for r in seeded.collect() if r.id == 1][0].sale_price
    assert rows[1].sale_price == (s20 / D("0.80") * D("0.65")).quantize(D("0.01"))
    ordered = [r.id for r in P.active_promos(updated).orderBy(F.col("discount_pct").desc(), "id").collect()]
    assert ordered[:3] == [15, 12, 13]

    # Snapshot sync and triggered sync of the same history give equal tables.
    st = TableStore(spark, scratch + "/serving")
    sync_snapshot(st, seeded, "promos_a", keys=["id"], source_version=0)
    ch = (updated.withColumn("_change_type", F.lit("update_postimage")).withColumn("_commit_version", F.lit(1).cast("long"))
          .withColumn("_commit_ts", F.lit(NOW)).withColumn("_seq", F.lit(0)))
    sync_triggered(st, ch, "promos_a")
    sync_snapshot(st, updated, "promos_b", keys=["id"])
    a = sorted(tuple(r) for r in st.read("promos_a").collect())
    b = sorted(tuple(r) for r in st.read("promos_b").collect())
    assert a == b and len(a) == 15


def test_inventory_main_stock_by_product(spark):
    inv = spark.createDataFrame([(i + 1, *r) for i, r in enumerate(INVENTORY_MAIN)],
                                "id long, product_id long, warehouse string, quantity int, reserved int")
    got = {r.product_id: (r.quantity, r.reserved, r.available, r.warehouses)
           for r in C.stock_by_product({"inventory": inv}).collect()}
    assert len(got) == 15
    assert got[1] == (75, 7, 68, 2) and got[2] == (275, 23, 252, 2) and got[6] == (350, 5, 345, 2)
    assert sum(v[0] for v in got.values()) == sum(r[2] for r in INVENTORY_MAIN)


# ---------------------------------------------------------------------------
# Seed orders (customer_id, product_id, quantity, total, currency, order_date, status).
SEED_ORDERS = [
    (1, 1, 1, "1299.99", "USD", "2024-03-01 10:05:00", "delivered"),
    (1, 2, 1, "89.99", "USD", "2024-03-05 14:22:00", "delivered"),
    (2, 4, 1, "129.99", "USD", "2024-03-08 09:00:00", "shipped"),
    (3, 3, 1, "449.99", "EUR", "2024-03-10 11:30:00", "confirmed"),
    (4, 5, 2, "119.98", "EUR", "2024-03-12 16:45:00", "delivered"),
    (5, 2, 1, "89.99", "GBP", "2024-03-15 08:10:00", "shipped"),
    (6, 6, 3, "119.97", "AED", "2024-03-16 12:00:00", "pending"),
    (7, 1, 1, "1299.99", "JPY", "2024-03-18 07:30:00", "confirmed"),
    (8, 13, 2, "109.98", "EUR", "2024-03-19 15:15:00", "delivered"),
    (9, 10, 1, "99.99", "EUR", "2024-03-20 10:00:00", "shipped"),
    (10, 7, 1, "24.99", "INR", "2024-03-21 13:30:00", "delivered"),
    (11, 8, 1, "49.99", "BRL", "2024-03-22 09:45:00", "confirmed"),
    (12, 9, 2, "69.98", "CNY", "2024-03-23 18:20:00", "pending"),
    (1, 11, 1, "29.99", "USD", "2024-03-24 11:05:00", "shipped"),
    (2, 12, 2, "39.98", "USD", "2024-03-25 14:00:00", "delivered"),
    (3, 15, 1, "29.99", "EUR", "2024-03-26 16:30:00", "pending"),
    (4, 14, 1, "69.99", "EUR", "2024-03-27 08:00:00", "confirmed"),
    (5, 4, 1, "129.99", "GBP", "2024-03-28 12:45:00", "shipped"),
    (6, 3, 1, "449.99", "AED", "2024-03-29 10:10:00", "confirmed"),
    (7, 5, 1, "59.99", "JPY", "2024-03-30 07:50:00", "pending"),
    (8, 1, 1, "1299.99", "EUR", "2024-03-31 15:00:00", "confirmed"),
    (9, 2, 2, "179.98", "EUR", "2024-04-01 09:30:00", "shipped"),
]
# ---------------------------------------------------------------------------


def _half_up(x, q="0.01"):
    from decimal import ROUND_HALF_UP
    return x.quantize(D(q), rounding=ROUND_HALF_UP)


def test_seed_orders_golden(spark):
    from emporia.operators import loyalty as L
    from emporia.operators import orders as O
    from emporia.operators import versions as V
    from emporia.sources.tables import EXCHANGE_RATES, exchange_rates

    orders = spark.createDataFrame(
        [(i + 1, c, p, q, D(tot), cur, dt.datetime.fromisoformat(ts), st)
         for i, (c, p, q, tot, cur, ts, st) in enumerate(SEED_ORDERS)],
        "id long, customer_id long, product_id long, quantity int, total decimal(18,2), currency string, "
        "order_date timestamp_ntz, status string")
    customers = spark.range(1, 13).selectExpr("id", "concat('cust ', id) AS name",
                                              "concat('c', id, '@x.com') AS email")
    products = spark.range(1, 16).selectExpr("id", "concat('prod ', id) AS name",
                                             "CAST(10 AS DECIMAL(18,2)) AS price", "'Cat' AS category")
    t = {"orders": orders, "customers": customers, "products": products, "exchange_rates": exchange_rates(spark)}
    assert orders.count() == 22

    # D6 status summary
    want = {}
    for _, _, _, tot, _, _, st in SEED_ORDERS:
        want.setdefault(st, []).append(D(tot))
    got = {r.status: (r.cnt, r.avg_total) for r in O.status_summary(t).collect()}
    assert got == {k: (len(v), _half_up(sum(v) / len(v))) for k, v in want.items()}

    # B6 / D8 with the reference bounds (500, 200)
    pri = {r.id: r.priority for r in O.order_priority(orders).collect()}
    for i, row in enumerate(SEED_ORDERS):
        tot = D(row[3])
        assert pri[i + 1] == ("high" if tot > 500 else "medium" if tot > 200 else "normal")
    assert sorted(r.priority for r in O.priority_summary(t).collect()) == ["high", "medium", "normal"]

    # D13 loyalty points and B5 tiers with the reference cuts
    pts = {}
    for c, _, _, tot, _, _, _ in SEED_ORDERS:
        pts[c] = pts.get(c, 0) + int(D(tot))
    got_pts = {r.id: r.loyalty_points for r in L.loyalty_points(t).collect()}
    assert got_pts == {c: pts.get(c, 0) for c in range(1, 13)}
    tiers = {r.email: r.tier for r in L.enroll_members(L.backfill_points(t), "2024-04-02 00:00:00").collect()}
    assert tiers["c1@x.com"] == "Silver" and tiers["c3@x.com"] == "Bronze"

    # C7 orders in USD: ROUND(total * rate_to_usd, 2)
    rate = {c: D(r) for c, _, r in EXCHANGE_RATES}
    usd = {r.id: r.total_usd for r in O.orders_in_usd(t).collect()}
    assert usd == {i + 1: _half_up(D(row[3]) * rate[row[4]]) for i, row in enumerate(SEED_ORDERS)}

    # D11 revenue and G8 recovery: 22 orders and the same revenue after restore
    rev = O.total_revenue(t).collect()[0].revenue
    assert rev == sum(D(r[3]) for r in SEED_ORDERS)
    lost = orders.filter("status <> 'pending'")
    restored = V.restore_missing(lost, orders, ["id"])
    chk = V.recovery_check(orders, restored).collect()[0]
    assert (chk.before_rows, chk.after_rows, chk.match) == (22, 22, True)
