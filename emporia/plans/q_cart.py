"""Registered cart / checkout queries.

The oracle folds every cart event by brute force (a recursive CTE that
steps through each (customer, product) sequence one event at a time), an
independent check of the closed form used by ``cart_state``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.operators import cart as H
from emporia.operators import catalog as C
from emporia.operators import loyalty as L
from emporia.operators import orders as O
from emporia.operators import checks as K
from emporia.plans.q_loyalty import ENROLLED_AT, TD_CUTS, _MEMBERS_SQL
from emporia.plans.registry import register
from emporia.sources.tables import ITEMS_PER_ORDER, with_sql

CHECKOUT_AT = "2024-02-01 00:00:00"

CART_SQL = """(WITH RECURSIVE
  ev AS (SELECT customer_id, product_id, ts, event_id, action, quantity FROM cart_events
         WHERE action IN ('add', 'update') AND product_id IN (SELECT id FROM products)),
  ks AS (SELECT DISTINCT customer_id, product_id FROM ev),
  allev AS (SELECT * FROM ev UNION ALL
            SELECT k.customer_id, k.product_id, c.ts, c.event_id, 'clear', NULL
            FROM ks k JOIN cart_events c ON c.customer_id = k.customer_id AND c.action = 'clear'),
  seq AS (SELECT *, row_number() OVER (PARTITION BY customer_id, product_id ORDER BY ts, event_id) AS n FROM allev),
  fold(customer_id, product_id, n, qty) AS (
    SELECT customer_id, product_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM ks
    UNION ALL
    SELECT f.customer_id, f.product_id, s.n,
           CASE WHEN s.action = 'clear' THEN 0
                WHEN s.action = 'add' THEN CASE WHEN s.quantity >= 1 THEN f.qty + s.quantity ELSE f.qty END
                ELSE CASE WHEN f.qty > 0 THEN greatest(s.quantity, 0) ELSE 0 END END
    FROM fold f JOIN seq s ON s.customer_id = f.customer_id AND s.product_id = f.product_id AND s.n = f.n + 1)
  SELECT customer_id, product_id, CAST(qty AS BIGINT) AS quantity FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, product_id ORDER BY n DESC) AS r FROM fold)
  WHERE r = 1 AND qty > 0)"""

STOCK_SQL = "(SELECT product_id, arg_max(quantity, id) AS stock FROM inventory GROUP BY product_id)"
PROMO_SQL = ("(SELECT product_id, arg_max(sale_price, id) AS sale_price, arg_max(badge_text, id) AS badge_text, "
             "arg_max(discount_pct, id) AS discount_pct FROM promotions WHERE is_active GROUP BY product_id)")
EFF_SQL = ("CAST(CASE WHEN pr.sale_price IS NOT NULL AND pr.sale_price <> 0 THEN pr.sale_price ELSE p.price END "
           "AS DECIMAL(18,2))")
PRICED_SQL = f"""(SELECT c.customer_id, c.product_id, p.name, p.category, p.price, COALESCE(s.stock, 0) AS stock,
       c.quantity AS cart_quantity, pr.sale_price, pr.badge_text, pr.discount_pct,
       {EFF_SQL} AS effective_price,
       CAST(ROUND({EFF_SQL} * c.quantity, 2) AS DECIMAL(38,2)) AS line_total,
       COALESCE(s.stock, 0) >= c.quantity AS in_stock,
       CAST(FLOOR({EFF_SQL}) * c.quantity AS BIGINT) AS loyalty_points_earned
    FROM {CART_SQL} c JOIN products p ON p.id = c.product_id
    LEFT JOIN {STOCK_SQL} s ON s.product_id = c.product_id LEFT JOIN {PROMO_SQL} pr ON pr.product_id = c.product_id)"""
SHOPPERS_SQL = "(SELECT DISTINCT customer_id FROM cart_events)"
VALID_SQL = f"""(SELECT sh.customer_id, COALESCE(v.lines, 0) AS lines, COALESCE(v.unknown_lines, 0) AS unknown_lines,
       COALESCE(v.short_lines, 0) AS short_lines,
       CASE WHEN v.lines IS NULL THEN 'empty' WHEN v.unknown_lines > 0 OR v.short_lines > 0 THEN 'rejected'
            ELSE 'ok' END AS status,
       CASE WHEN v.lines IS NULL THEN 'cart is empty' WHEN v.unknown_lines > 0 THEN 'product not found'
            WHEN v.short_lines > 0 THEN 'not enough stock' END AS reason
    FROM {SHOPPERS_SQL} sh LEFT JOIN (
      SELECT c.customer_id, COUNT(*) AS lines, COUNT(*) FILTER (WHERE p.id IS NULL) AS unknown_lines,
             COUNT(*) FILTER (WHERE p.id IS NOT NULL AND COALESCE(s.stock, 0) < c.quantity) AS short_lines
      FROM {CART_SQL} c LEFT JOIN products p ON p.id = c.product_id LEFT JOIN {STOCK_SQL} s ON s.product_id = c.product_id
      GROUP BY c.customer_id) v ON v.customer_id = sh.customer_id)"""
TIMED_SQL = f"""(SELECT c.*, ts.ts FROM {CART_SQL} c JOIN (SELECT customer_id, MAX(ts) AS ts FROM cart_events GROUP BY customer_id) ts
    ON ts.customer_id = c.customer_id)"""
# Checkout cart by cart: each step looks at one cart and at what the carts accepted so far have taken.
ACCEPTED_SQL = f"""(WITH RECURSIVE
  timed AS MATERIALIZED (SELECT * FROM {TIMED_SQL}),
  numbered AS (SELECT customer_id, row_number() OVER (ORDER BY ts, customer_id) AS n
               FROM (SELECT DISTINCT customer_id, ts FROM timed)),
  carts AS MATERIALIZED (SELECT n.n, list({{'p': l.product_id, 'q': l.quantity,
                 's': CASE WHEN p.id IS NOT NULL THEN COALESCE(s.stock, 0) END}}) AS lines
            FROM numbered n JOIN timed l ON l.customer_id = n.customer_id LEFT JOIN products p ON p.id = l.product_id
            LEFT JOIN {STOCK_SQL} s ON s.product_id = l.product_id GROUP BY n.n),
  step(n, ok, used) AS (
    SELECT CAST(0 AS BIGINT), false, CAST([] AS STRUCT(p BIGINT, q BIGINT, s INTEGER)[])
    UNION ALL
    SELECT c.n, fits, CASE WHEN fits THEN list_concat(used, lines) ELSE used END
    FROM (SELECT c.n, c.lines, st.used, len(list_filter(c.lines, lambda x: x.s IS NULL OR
            x.s - COALESCE(list_sum(list_transform(list_filter(st.used, lambda u: u.p = x.p), lambda u: u.q)), 0) < x.q)) = 0 AS fits
          FROM step st JOIN carts c ON c.n = st.n + 1) c)
  SELECT l.customer_id, l.product_id, l.quantity, l.ts, p.price FROM timed l JOIN products p ON p.id = l.product_id
  JOIN numbered n ON n.customer_id = l.customer_id JOIN step st ON st.n = n.n AND st.ok)"""
_CART_TABLES = ("cart_events", "products", "inventory", "promotions")


def _cart(t):
    return H.cart_state(t.cart_events, t.products)


def _timed_cart(t):
    """The carts with the time of the customer's last cart event."""
    return _cart(t).join(t.cart_events.groupBy("customer_id").agg(F.max("ts").alias("ts")), "customer_id")


def _items_start(t):
    """One row: an id above those of all items (ids follow the orders, see ``order_items_from``)."""
    return t.order_items.select(((F.max("order_id") + 1) * ITEMS_PER_ORDER + 1).alias("s"))


def _shoppers(t):
    return t.cart_events.select("customer_id")


@register("cart_state", with_sql(f"SELECT * FROM {CART_SQL}", "cart_events", "products"))
def q_cart_state(t):
    """H1 final cart of every customer folded from add / update / clear events."""
    return _cart(t)


@register("price_cart", with_sql(f"SELECT * FROM {PRICED_SQL}", *_CART_TABLES))
def q_price_cart(t):
    """H2 priced cart lines (sale price, stock, points)."""
    return H.price_cart(_cart(t), t)


@register("cart_totals", with_sql(f"""
    SELECT k.customer_id, COALESCE(m.subtotal, 0) AS subtotal, k.item_count,
           COALESCE(m.total_points_earned, 0) AS total_points_earned, tr.loyalty_tier
    FROM (SELECT customer_id, CAST(SUM(quantity) AS BIGINT) AS item_count FROM {CART_SQL} GROUP BY customer_id) k
    LEFT JOIN (SELECT customer_id, CAST(ROUND(SUM(effective_price * cart_quantity), 2) AS DECIMAL(38,2)) AS subtotal,
                      CAST(SUM(loyalty_points_earned) AS BIGINT) AS total_points_earned
               FROM {PRICED_SQL} GROUP BY customer_id) m ON m.customer_id = k.customer_id
    LEFT JOIN (SELECT c.id AS customer_id, mm.tier AS loyalty_tier FROM {_MEMBERS_SQL} mm
               JOIN customers c ON c.email = mm.email) tr ON tr.customer_id = k.customer_id""",
                                  *_CART_TABLES, "customers", "orders"))
def q_cart_totals(t):
    """H3 per-customer subtotal, item count, points and loyalty tier."""
    cart = _cart(t)
    members = L.enroll_members(L.backfill_points(t), ENROLLED_AT, TD_CUTS)
    return H.cart_totals(cart, H.price_cart(cart, t), t, members)


@register("validate_checkout", with_sql(f"SELECT * FROM {VALID_SQL}", *_CART_TABLES))
def q_validate_checkout(t):
    """H4 every shopper's cart: empty / rejected (unknown product, short stock) / ok."""
    return H.validate_checkout(_cart(t), t, _shoppers(t))


# Every fifth customer's cart also holds a product that is not in the catalog.
UNKNOWN_SQL = f"""(SELECT customer_id, product_id, quantity FROM {CART_SQL}
    UNION ALL SELECT DISTINCT customer_id, CAST(-1 - customer_id AS BIGINT), CAST(2 AS BIGINT) FROM cart_events WHERE customer_id % 5 = 0)"""


def _cart_with_unknown(t):
    extra = (t.cart_events.filter(F.col("customer_id") % 5 == 0).select("customer_id").distinct()
             .select("customer_id", (-1 - F.col("customer_id")).cast("long").alias("product_id"), F.lit(2).cast("long").alias("quantity")))
    return _cart(t).select("customer_id", "product_id", "quantity").unionByName(extra)


@register("price_cart_unknown", with_sql(f"SELECT * FROM {PRICED_SQL.replace(CART_SQL, UNKNOWN_SQL)}", *_CART_TABLES))
def q_price_cart_unknown(t):
    """H2 carts with unknown products: those lines are skipped."""
    return H.price_cart(_cart_with_unknown(t), t)


@register("cart_totals_unknown", with_sql(f"""
    SELECT k.customer_id, COALESCE(m.subtotal, 0) AS subtotal, k.item_count, COALESCE(m.total_points_earned, 0) AS total_points_earned
    FROM (SELECT customer_id, CAST(SUM(quantity) AS BIGINT) AS item_count FROM {UNKNOWN_SQL} GROUP BY customer_id) k
    LEFT JOIN (SELECT customer_id, CAST(ROUND(SUM(effective_price * cart_quantity), 2) AS DECIMAL(38,2)) AS subtotal,
                      CAST(SUM(loyalty_points_earned) AS BIGINT) AS total_points_earned
               FROM {PRICED_SQL.replace(CART_SQL, UNKNOWN_SQL)} GROUP BY customer_id) m ON m.customer_id = k.customer_id""", *_CART_TABLES))
def q_cart_totals_unknown(t):
    """H3 item counts include unknown products, money and points do not."""
    cart = _cart_with_unknown(t)
    return H.cart_totals(cart, H.price_cart(cart, t), t)


@register("validate_checkout_unknown", with_sql(f"SELECT * FROM {VALID_SQL.replace(CART_SQL, UNKNOWN_SQL)}", *_CART_TABLES))
def q_validate_checkout_unknown(t):
    """H4 carts with unknown products are rejected."""
    return H.validate_checkout(_cart_with_unknown(t), t, _shoppers(t))


@register("checkout_orders", with_sql(f"""
    SELECT CAST((SELECT MAX(id) FROM orders) + row_number() OVER (ORDER BY customer_id, product_id) AS BIGINT) AS id,
           customer_id, product_id, quantity, CAST(ROUND(price * quantity, 2) AS DECIMAL(18,2)) AS total,
           'USD' AS currency, TIMESTAMP '{CHECKOUT_AT}' AS order_date, 'pending' AS status
    FROM {ACCEPTED_SQL}""", *_CART_TABLES, "orders"))
def q_checkout_orders(t):
    """H5 + E7 one new pending order per accepted line, ids after max(orders.id)."""
    return H.checkout(_timed_cart(t), t, _shoppers(t), CHECKOUT_AT,
                      items_start=_items_start(t))["orders"]


@register("checkout_items", with_sql(f"""
    SELECT CAST((SELECT (MAX(l_orderkey) + 1) * {ITEMS_PER_ORDER} FROM lineitem) + row_number() OVER (ORDER BY customer_id, product_id) AS BIGINT) AS id,
           CAST((SELECT MAX(id) FROM orders) + row_number() OVER (ORDER BY customer_id, product_id) AS BIGINT) AS order_id,
           product_id, quantity, CAST(price AS DECIMAL(18,2)) AS unit_price,
           CAST(ROUND(price * quantity, 2) AS DECIMAL(18,2)) AS line_total
    FROM {ACCEPTED_SQL}""", *_CART_TABLES, "orders"))
def q_checkout_items(t):
    """H5 one order item per new order, ids after the existing items."""
    return H.checkout(_timed_cart(t), t, _shoppers(t), CHECKOUT_AT,
                      items_start=_items_start(t))["order_items"]


# Every warehouse row goes through the accepted lines of its product one after the other.
@register("checkout_inventory", with_sql(f"""
    SELECT * FROM (WITH RECURSIVE
      lines AS MATERIALIZED (SELECT * FROM {ACCEPTED_SQL}),
      seq AS MATERIALIZED (SELECT i.id, l.quantity AS q, row_number() OVER (PARTITION BY i.id ORDER BY l.ts, l.customer_id) AS n
              FROM inventory i JOIN lines l ON l.product_id = i.product_id),
      fold(id, n, left_over) AS (
        SELECT id, CAST(0 AS BIGINT), CAST(quantity AS BIGINT) FROM inventory
        UNION ALL
        SELECT f.id, s.n, CASE WHEN f.left_over >= s.q THEN f.left_over - s.q ELSE f.left_over END
        FROM fold f JOIN seq s ON s.id = f.id AND s.n = f.n + 1)
    SELECT i.id, i.product_id, i.warehouse, CAST(x.left_over AS INTEGER) AS quantity, i.reorder_level, i.reserved
    FROM inventory i JOIN (SELECT id, arg_max(left_over, n) AS left_over FROM fold GROUP BY id) x ON x.id = i.id)""", *_CART_TABLES))
def q_checkout_inventory(t):
    """H5 + E5 stock after checkout: quantity -= n where quantity >= n, every warehouse row, line after line."""
    return H.checkout(_timed_cart(t), t, _shoppers(t), CHECKOUT_AT)["inventory"]


@register("checkout_points", with_sql(f"""
    SELECT customer_id, CAST(SUM(FLOOR(price) * quantity) AS BIGINT) AS points FROM {ACCEPTED_SQL}
    GROUP BY customer_id""", *_CART_TABLES))
def q_checkout_points(t):
    """H6 points earned per customer at checkout."""
    return H.checkout(_timed_cart(t), t, _shoppers(t), CHECKOUT_AT)["points"]


@register("award_points", with_sql(f"""
    SELECT b.id, b.name, b.email, b.segment, b.nation_id,
           CAST(b.loyalty_points + COALESCE(p.points, 0) AS BIGINT) AS loyalty_points
    FROM (SELECT c.*, pts.loyalty_points FROM customers c JOIN
          (SELECT c.id, CAST(COALESCE(SUM(CAST(FLOOR(o.total) AS INTEGER)), 0) AS BIGINT) AS loyalty_points
           FROM customers c LEFT JOIN orders o ON o.customer_id = c.id GROUP BY c.id) pts ON pts.id = c.id) b
    LEFT JOIN (SELECT customer_id, SUM(FLOOR(price) * quantity) AS points FROM {ACCEPTED_SQL} GROUP BY customer_id) p
      ON p.customer_id = b.id""", *_CART_TABLES, "customers", "orders"))
def q_award_points(t):
    """E6 loyalty points += checkout points."""
    pts = H.checkout(_timed_cart(t), t, _shoppers(t), CHECKOUT_AT)["points"]
    return L.award_points(L.backfill_points(t), pts.withColumnRenamed("customer_id", "customer_id"))


@register("allocate_stock", with_sql(f"""
    SELECT * FROM (WITH RECURSIVE
      seq AS MATERIALIZED (SELECT c.*, COALESCE(s.stock, 0) AS stock,
                row_number() OVER (PARTITION BY c.product_id ORDER BY c.ts, c.customer_id) AS n
              FROM {TIMED_SQL} c LEFT JOIN {STOCK_SQL} s ON s.product_id = c.product_id),
      fold(customer_id, product_id, quantity, ts, stock, n, remaining) AS (
        SELECT customer_id, product_id, quantity, ts, stock, n, CAST(stock AS BIGINT) FROM seq WHERE n = 1
        UNION ALL
        SELECT s.customer_id, s.product_id, s.quantity, s.ts, s.stock, s.n,
               CASE WHEN f.quantity <= f.remaining THEN f.remaining - f.quantity ELSE f.remaining END
        FROM fold f JOIN seq s ON s.product_id = f.product_id AND s.n = f.n + 1)
    SELECT customer_id, product_id, quantity, ts, stock, remaining, quantity <= remaining AS granted FROM fold)""", *_CART_TABLES))
def q_allocate_stock(t):
    """H7 first-come-first-served stock allocation over all lines at once."""
    return H.allocate_stock(_timed_cart(t), t.inventory).select(
        "customer_id", "product_id", "quantity", "ts", "stock", "remaining", "granted")


@register("migrate_currency", with_sql("""
    SELECT o.id, o.customer_id, o.total, o.order_date, o.status, er.id AS currency_id
    FROM orders o LEFT JOIN exchange_rates er ON er.currency_code = o.currency""", "orders", "exchange_rates"))
def q_migrate_currency(t):
    """E3 add currency_id, fill from the code, require NOT NULL, drop the code."""
    return migrate_currency(t)


def migrate_currency(t):
    o = O.fk_assign(t.orders, t.exchange_rates)
    missing = K.check_not_null(o, ["currency_id"]).limit(1).count()
    if missing:
        raise ValueError("currency_id would be NULL for some orders; migration stopped")
    return C.drop_column(o, "currency")
