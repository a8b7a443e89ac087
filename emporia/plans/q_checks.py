"""Registered constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators import checks as K
from emporia.plans.registry import register
from emporia.sources.tables import with_sql

_STATUSES = ", ".join(f"'{s}'" for s in S.ORDER_STATUSES)
# Parent rows taken away to exercise FK and cascade checks (TD has no
# orphans): customers of one market segment, orders still pending.
GONE_SEGMENT = "AUTOMOBILE"
GONE_STATUS = "pending"
STOCK_HIGH = 150


@register("check_unique_lines", """
    SELECT l_orderkey AS order_id, l_linenumber AS line_number, COUNT(*) AS occurrences
    FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def q_check_unique_lines(t):
    """F1 (order, line number) must be unique -- TD has real duplicates."""
    li = t.raw("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"))
    return K.check_unique(li, ["order_id", "line_number"])


@register("check_unique_inventory", with_sql("""
    SELECT product_id, warehouse, COUNT(*) AS occurrences FROM inventory GROUP BY 1, 2 HAVING COUNT(*) > 1""",
                                             "inventory"))
def q_check_unique_inventory(t):
    """F1 composite UNIQUE(product_id, warehouse)."""
    return K.check_unique(t.inventory, ["product_id", "warehouse"])


@register("check_unique_stocked", with_sql("""
    SELECT product_id, COUNT(*) AS occurrences FROM inventory GROUP BY 1 HAVING COUNT(*) > 1""", "inventory"))
def q_check_unique_stocked(t):
    """F1 products stocked in one warehouse only: finds those with several inventory rows."""
    return K.check_unique(t.inventory, ["product_id"])


@register("check_not_null", with_sql("""
    SELECT *, list_filter([CASE WHEN product_id IS NULL THEN 'product_id' END,
                           CASE WHEN quantity IS NULL THEN 'quantity' END], lambda x: x IS NOT NULL) AS null_columns
    FROM cart_events WHERE product_id IS NULL OR quantity IS NULL""", "cart_events"))
def q_check_not_null(t):
    """F2 NOT NULL on cart lines (clear events carry no product)."""
    return K.check_not_null(t.cart_events, ["product_id", "quantity"])


@register("check_domain_status", with_sql(f"""
    SELECT * FROM orders WHERE status IS NOT NULL AND status NOT IN ({_STATUSES})""", "orders"))
def q_check_domain_status(t):
    """F3 CHECK status IN (...)."""
    return K.check_domain(t.orders, "status", values=S.ORDER_STATUSES)


OPEN_STATUSES = ("pending", "confirmed")


@register("check_domain_open", with_sql("""
    SELECT * FROM orders WHERE status IS NOT NULL AND status NOT IN ('pending', 'confirmed')""", "orders"))
def q_check_domain_open(t):
    """F3 CHECK status IN (open statuses): finds the delivered orders."""
    return K.check_domain(t.orders, "status", values=OPEN_STATUSES)


@register("check_domain_range", with_sql(f"""
    SELECT * FROM inventory WHERE quantity IS NOT NULL AND (quantity < 0 OR quantity > {STOCK_HIGH})""", "inventory"))
def q_check_domain_range(t):
    """F3 CHECK quantity BETWEEN 0 AND 150."""
    return K.check_domain(t.inventory, "quantity", low=0, high=STOCK_HIGH)


@register("check_foreign_key", with_sql(f"""
    SELECT o.* FROM orders o WHERE o.customer_id IS NOT NULL AND NOT EXISTS (
      SELECT 1 FROM customers c WHERE c.id = o.customer_id AND c.segment <> '{GONE_SEGMENT}')""",
                                        "orders", "customers"))
def q_check_foreign_key(t):
    """F4 orders whose customer is gone."""
    parent = t.customers.filter(F.col("segment") != GONE_SEGMENT)
    return K.check_foreign_key(t.orders, ["customer_id"], parent, ["id"])


@register("cascade_delete", with_sql(f"""
    SELECT oi.* FROM order_items oi WHERE EXISTS (
      SELECT 1 FROM orders o WHERE o.id = oi.order_id AND o.status <> '{GONE_STATUS}')""", "order_items", "orders"))
def q_cascade_delete(t):
    """F5 order items left after deleting pending orders (ON DELETE CASCADE)."""
    parent = t.orders.filter(F.col("status") != GONE_STATUS)
    return K.cascade_delete(t.order_items, ["order_id"], parent, ["id"])


@register("check_summary", with_sql(f"""
    SELECT 'unique_lines' AS "check", COUNT(*) AS violations FROM (
      SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
    UNION ALL SELECT 'stock_range', COUNT(*) FROM inventory WHERE quantity < 0 OR quantity > {STOCK_HIGH}
    UNION ALL SELECT 'cart_not_null', COUNT(*) FROM cart_events WHERE product_id IS NULL OR quantity IS NULL""",
                                    "inventory", "cart_events"))
def q_check_summary(t):
    """F1-F3 violation counts in one job."""
    li = t.raw("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"))
    return K.summary({
        "unique_lines": K.check_unique(li, ["order_id", "line_number"]),
        "stock_range": K.check_domain(t.inventory, "quantity", low=0, high=STOCK_HIGH),
        "cart_not_null": K.check_not_null(t.cart_events, ["product_id", "quantity"]),
    })


@register("check_rows", with_sql("""
    SELECT 'status' AS "check", COUNT(*) FILTER (WHERE status NOT IN ('pending', 'confirmed')) AS violations FROM orders
    UNION ALL SELECT 'total', COUNT(*) FILTER (WHERE total > 300000) FROM orders
    UNION ALL SELECT 'customer', COUNT(*) FILTER (WHERE customer_id IS NULL OR order_date IS NULL) FROM orders""", "orders"))
def q_check_rows(t):
    """F2 + F3 several row checks of one table in one scan."""
    return K.row_violations(t.orders, {"status": K.violates_domain("status", values=OPEN_STATUSES),
                                       "total": K.violates_domain("total", high=300000),
                                       "customer": K.violates_not_null(["customer_id", "order_date"])})
