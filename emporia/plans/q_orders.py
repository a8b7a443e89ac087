"""Registered order queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators import orders as O
from emporia.plans.registry import register
from emporia.sources.tables import with_sql

# TD order totals are all above 1,000, so the reference bounds (500, 200)
# would put every order in 'high'; these bounds split TD orders three ways.
TD_HIGH, TD_MEDIUM = 300000, 150000
ONE_CUSTOMER = 7

_ORDER_PRODUCTS = "(SELECT order_id, product_id, quantity FROM order_items)"


@register("order_priority", with_sql(f"""
    SELECT *, {S.order_priority_sql('total', TD_HIGH, TD_MEDIUM)} AS priority FROM orders""", "orders"))
def q_order_priority(t):
    """B6 priority from total."""
    return O.order_priority(t.orders, TD_HIGH, TD_MEDIUM)


@register("email_verified", with_sql("SELECT *, (id % 3 = 0) AS email_verified FROM customers", "customers"))
def q_email_verified(t):
    """B7 email_verified = id % 3 = 0."""
    return O.email_verified(t.customers)


@register("order_history", with_sql(f"""
    SELECT o.id, o.customer_id, p.name AS product, op.quantity, o.total, o.currency, o.order_date, o.status
    FROM orders o JOIN {_ORDER_PRODUCTS} op ON op.order_id = o.id JOIN products p ON p.id = op.product_id""",
                                    "orders", "order_items", "products"))
def q_order_history(t):
    """C2 order history of every customer."""
    return O.order_history(t)


@register("order_history_customer", with_sql(f"""
    SELECT o.id, o.customer_id, p.name AS product, op.quantity, o.total, o.currency, o.order_date, o.status
    FROM orders o JOIN {_ORDER_PRODUCTS} op ON op.order_id = o.id JOIN products p ON p.id = op.product_id
    WHERE o.customer_id = {ONE_CUSTOMER} ORDER BY o.order_date DESC""", "orders", "order_items", "products"))
def q_order_history_customer(t):
    """C2 for one customer (the storefront call)."""
    return O.order_history(t, customer=ONE_CUSTOMER).orderBy(O.F.col("order_date").desc())


@register("order_detail", with_sql("""
    SELECT o.id, c.name AS customer, o.order_date, o.status, o.total, o.currency
    FROM orders o JOIN customers c ON c.id = o.customer_id""", "orders", "customers"))
def q_order_detail(t):
    """C3 orders JOIN customers (all orders)."""
    return O.order_detail(t)


@register("order_lines", with_sql("""
    SELECT oi.id, oi.order_id, p.name AS product, oi.quantity, oi.unit_price, oi.line_total
    FROM order_items_ided oi JOIN products p ON p.id = oi.product_id""", "order_items_ided", "products"))
def q_order_lines(t):
    """C4 order lines with dense item ids (all orders)."""
    return O.order_lines(t)


@register("orders_enriched", with_sql(f"""
    SELECT o.id, c.name AS customer, p.name AS product, op.quantity, o.total, o.currency, o.status
    FROM orders o JOIN customers c ON c.id = o.customer_id
    JOIN {_ORDER_PRODUCTS} op ON op.order_id = o.id JOIN products p ON p.id = op.product_id""",
                                      "orders", "customers", "order_items", "products"))
def q_orders_enriched(t):
    """C6 orders JOIN customers JOIN products."""
    return O.orders_enriched(t)


@register("orders_in_usd", with_sql(f"""
    SELECT o.id, c.name AS customer, p.name AS product, op.quantity, o.total, er.currency_code, er.rate_to_usd,
           CAST(ROUND(o.total * er.rate_to_usd, 2) AS DECIMAL(18,2)) AS total_usd
    FROM orders o JOIN customers c ON c.id = o.customer_id
    JOIN {_ORDER_PRODUCTS} op ON op.order_id = o.id JOIN products p ON p.id = op.product_id
    JOIN exchange_rates er ON er.currency_code = o.currency""",
                                    "orders", "customers", "order_items", "products", "exchange_rates"))
def q_orders_in_usd(t):
    """C7 four-way join with ROUND(total * rate_to_usd, 2)."""
    return O.orders_in_usd(t)


@register("fk_assign", with_sql("""
    SELECT o.*, er.id AS currency_id FROM orders o LEFT JOIN exchange_rates er ON er.currency_code = o.currency""",
                                "orders", "exchange_rates"))
def q_fk_assign(t):
    """C12 currency_id from currency code."""
    return O.fk_assign(t.orders, t.exchange_rates)


@register("status_summary", with_sql(f"""
    SELECT status, COUNT(*) AS cnt, {S.avg_round_sql('total', 2, 2)} AS avg_total FROM orders GROUP BY status""",
                                     "orders"))
def q_status_summary(t):
    """D6 per status count and ROUND(AVG(total), 2)."""
    return O.status_summary(t)


@register("category_price_range", with_sql("""
    SELECT category, COUNT(*) AS cnt, CAST(ROUND(MIN(price), 2) AS DECIMAL(18,2)) AS min_price,
           CAST(ROUND(MAX(price), 2) AS DECIMAL(18,2)) AS max_price FROM products GROUP BY category""", "products"))
def q_category_price_range(t):
    """D7 per category count, min, max price."""
    return O.category_price_range(t)


@register("priority_summary", with_sql(f"""
    SELECT priority, COUNT(*) AS cnt, {S.avg_round_sql('total', 2, 2)} AS avg_total
    FROM (SELECT *, {S.order_priority_sql('total', TD_HIGH, TD_MEDIUM)} AS priority FROM orders) GROUP BY priority""",
                                       "orders"))
def q_priority_summary(t):
    """D8 per priority count and average total."""
    return O.priority_summary(t, TD_HIGH, TD_MEDIUM)


@register("verified_counts", with_sql("""
    SELECT (id % 3 = 0) AS email_verified, COUNT(*) AS cnt FROM customers GROUP BY 1""", "customers"))
def q_verified_counts(t):
    """D9 customers per email_verified."""
    return O.verified_counts(t)


@register("top_customers_by_spend", with_sql("""
    SELECT c.name, COUNT(o.id) AS order_count, CAST(ROUND(SUM(o.total), 2) AS DECIMAL(38,2)) AS total_spent
    FROM customers c JOIN orders o ON c.id = o.customer_id
    GROUP BY c.name ORDER BY total_spent DESC, c.name LIMIT 5""", "customers", "orders"))
def q_top_customers_by_spend(t):
    """D10 top 5 customers (by name) by total spend."""
    return O.top_customers_by_spend(t, 5, "name")


@register("total_revenue", with_sql("""
    SELECT CAST(COALESCE(SUM(total), 0) AS DECIMAL(38,2)) AS revenue FROM orders""", "orders"))
def q_total_revenue(t):
    """D11 COALESCE(SUM(total), 0)."""
    return O.total_revenue(t)


@register("total_revenue_usd", with_sql("""
    SELECT CAST(COALESCE(SUM(ROUND(o.total * er.rate_to_usd, 2)), 0) AS DECIMAL(38,2)) AS revenue_usd
    FROM orders o JOIN exchange_rates er ON er.currency_code = o.currency""", "orders", "exchange_rates"))
def q_total_revenue_usd(t):
    """D11b revenue converted to USD per order."""
    return O.total_revenue(t, usd=True)


_COUNTED = ["customers", "products", "orders", "order_items", "inventory"]


@register("table_counts", with_sql(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in _COUNTED), *_COUNTED))
def q_table_counts(t):
    """D12 row count per table."""
    return O.table_counts(t, _COUNTED)


@register("rates_values", with_sql("""
    SELECT er.*, COALESCE(u.orders, 0) AS orders
    FROM exchange_rates er LEFT JOIN (SELECT currency, COUNT(*) AS orders FROM orders GROUP BY currency) u
      ON u.currency = er.currency_code""", "exchange_rates", "orders"))
def q_rates_values(t):
    """A2 literal rows as a table (exchange rates), with how many orders use each."""
    use = t.orders.groupBy("currency").agg(F.count(F.lit(1)).alias("orders"))
    return (t.exchange_rates.join(use, F.col("currency_code") == F.col("currency"), "left")
            .select(*t.exchange_rates.columns, F.coalesce(F.col("orders"), F.lit(0)).alias("orders")))


@register("top_customers_by_spend_id", with_sql("""
    SELECT c.id AS customer_id, c.name, COUNT(o.id) AS order_count,
           CAST(ROUND(SUM(o.total), 2) AS DECIMAL(38,2)) AS total_spent
    FROM customers c JOIN orders o ON c.id = o.customer_id
    GROUP BY c.id, c.name ORDER BY total_spent DESC, c.id LIMIT 5""", "customers", "orders"))
def q_top_customers_by_spend_id(t):
    """D10 with by='id': namesakes kept apart."""
    return O.top_customers_by_spend(t, 5, "id")


ONE_ORDER = 32


@register("order_detail_one", with_sql(f"""
    SELECT o.id, c.name AS customer, o.order_date, o.status, o.total, o.currency
    FROM orders o JOIN customers c ON c.id = o.customer_id
    WHERE o.id = {ONE_ORDER} AND o.customer_id = (SELECT customer_id FROM orders WHERE id = {ONE_ORDER})""",
                                       "orders", "customers"))
def q_order_detail_one(t):
    """C3 for one order of its own customer (the storefront call)."""
    cust = t.orders.filter(F.col("id") == ONE_ORDER).select("customer_id")
    scoped = {"orders": t.orders.join(cust, "customer_id", "left_semi"), "customers": t.customers}
    return O.order_detail(scoped, order=ONE_ORDER)


@register("order_lines_one", with_sql(f"""
    SELECT oi.id, oi.order_id, p.name AS product, oi.quantity, oi.unit_price, oi.line_total
    FROM order_items_ided oi JOIN products p ON p.id = oi.product_id WHERE oi.order_id = {ONE_ORDER}
    ORDER BY oi.id""", "order_items_ided", "products"))
def q_order_lines_one(t):
    """C4 lines of one order, by item id."""
    return O.order_lines(t, order=ONE_ORDER).orderBy("id")
