"""Order operators: history, detail, lines, enrichment, currency, summaries.

Keys B6, B7, C2-C4, C6, C7, C12, D6-D12. Joins between large tables are
left to Catalyst/AQE (sort-merge or shuffle-hash, broadcast only when the
runtime size is under the configured threshold). The exchange-rate table is a
literal of eight rows and is broadcast explicitly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators.common import has_column, table, top_k


def order_priority(df: DataFrame, high=S.PRIORITY_HIGH, medium=S.PRIORITY_MEDIUM,
                   total_col: str = "total") -> DataFrame:
    """priority = 'high' if total > high, 'medium' if > medium, else 'normal'."""
    return df.withColumn("priority", S.order_priority(total_col, high, medium))


def email_verified(df: DataFrame, id_col: str = "id") -> DataFrame:
    """email_verified = (id % 3 = 0)."""
    return df.withColumn("email_verified", F.pmod(F.col(id_col), F.lit(3)) == 0)


def _order_products(t) -> DataFrame:
    """(order_id, product_id, quantity) per order: the reference's orders carry one
    product; when an order_items table exists (TD) each line is one product."""
    o = table(t, "orders")
    if has_column(o, "product_id"):
        return o.select(F.col("id").alias("order_id"), "product_id", "quantity")
    return table(t, "order_items").select("order_id", "product_id", "quantity")


def order_history(t, customer=None) -> DataFrame:
    """Orders JOIN products (product name), optional priority, newest first.

    ``customer=None`` returns every customer's history (the batch form); the
    storefront's single-customer call is a filter pushed below the join.
    """
    o = table(t, "orders")
    if customer is not None:
        o = o.filter(F.col("customer_id") == customer)
    op = _order_products(t)
    if customer is not None and not has_column(table(t, "orders"), "product_id"):
        op = op.join(o.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    p = table(t, "products").select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    cols = ["id", "customer_id", "product", "quantity", "total", "currency", "order_date", "status"]
    if has_column(o, "priority"):
        cols.append("priority")
    j = (o.drop(*[c for c in ("product_id", "quantity") if has_column(o, c)])
         .join(op.withColumnRenamed("order_id", "id"), "id")
         .join(p, "product_id"))
    return j.select(*cols)


def order_detail(t, order=None, customer=None) -> DataFrame:
    """Orders JOIN customers by (order id, customer id)."""
    o = table(t, "orders")
    if order is not None:
        o = o.filter(F.col("id") == order)
    if customer is not None:
        o = o.filter(F.col("customer_id") == customer)
    c = table(t, "customers").select(F.col("id").alias("customer_id"), F.col("name").alias("customer"))
    cols = ["id", "customer", "order_date", "status", "total", "currency"]
    if has_column(o, "priority"):
        cols.append("priority")
    return o.join(c, "customer_id").select(*cols)


def order_lines(t, order=None) -> DataFrame:
    """C4: order_items JOIN products for an order (all orders when None)."""
    oi = table(t, "order_items_ided") if not isinstance(t, dict) else t["order_items"]
    if order is not None:
        oi = oi.filter(F.col("order_id") == order)
    p = table(t, "products").select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    return oi.join(p, "product_id").select("id", "order_id", "product", "quantity", "unit_price", "line_total")


def orders_enriched(t) -> DataFrame:
    """Orders JOIN customers JOIN products."""
    o = table(t, "orders")
    c = table(t, "customers").select(F.col("id").alias("customer_id"), F.col("name").alias("customer"))
    p = table(t, "products").select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    op = _order_products(t).withColumnRenamed("order_id", "id")
    base = o.drop(*[c_ for c_ in ("product_id", "quantity") if has_column(o, c_)])
    return (base.join(c, "customer_id").join(op, "id").join(p, "product_id")
            .select("id", "customer", "product", "quantity", "total", "currency", "status"))


def fk_assign(df: DataFrame, ref: DataFrame, code_col: str = "currency", ref_code: str = "currency_code",
              ref_id: str = "id", out_col: str = "currency_id") -> DataFrame:
    """UPDATE df SET out_col = ref.id FROM ref WHERE ref.code = df.code.

    Rows without a match keep NULL (checked by ``check_not_null`` in E3).
    ``ref`` is a lookup table (exchange rates); Spark broadcasts it if it is small.
    """
    r = ref.select(F.col(ref_code).alias("_code"), F.col(ref_id).alias(out_col))
    base = df.drop(out_col) if has_column(df, out_col) else df
    return (base.join(r, F.col(code_col) == F.col("_code"), "left")
                .drop("_code"))


def orders_in_usd(t) -> DataFrame:
    """Orders + customer + product + rate; total_usd = ROUND(total * rate_to_usd, 2)."""
    o = table(t, "orders")
    rates = table(t, "exchange_rates")
    if not has_column(o, "currency_id"):
        o = fk_assign(o, rates)
    c = table(t, "customers").select(F.col("id").alias("customer_id"), F.col("name").alias("customer"))
    p = table(t, "products").select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    r = rates.select(F.col("id").alias("currency_id"), "currency_code", "rate_to_usd")
    op = _order_products(t).withColumnRenamed("order_id", "id")
    base = o.drop(*[c_ for c_ in ("product_id", "quantity", "currency") if has_column(o, c_)])
    return (base.join(c, "customer_id").join(op, "id").join(p, "product_id").join(r, "currency_id")
            .select("id", "customer", "product", "quantity", "total", "currency_code", "rate_to_usd",
                    F.round(F.col("total") * F.col("rate_to_usd"), 2).cast("decimal(18,2)").alias("total_usd")))


def status_summary(t) -> DataFrame:
    """Per status count and ROUND(AVG(total), 2)."""
    return (table(t, "orders").groupBy("status")
            .agg(F.count(F.lit(1)).alias("cnt"), S.avg_round("total", 2, 2).alias("avg_total")))


def category_price_range(t) -> DataFrame:
    """Per category count, min and max price."""
    return (table(t, "products").groupBy("category")
            .agg(F.count(F.lit(1)).alias("cnt"),
                 F.round(F.min("price"), 2).cast("decimal(18,2)").alias("min_price"),
                 F.round(F.max("price"), 2).cast("decimal(18,2)").alias("max_price")))


def priority_summary(t, high=S.PRIORITY_HIGH, medium=S.PRIORITY_MEDIUM) -> DataFrame:
    """B6 then per priority count and ROUND(AVG(total), 2)."""
    o = order_priority(table(t, "orders"), high, medium)
    return o.groupBy("priority").agg(F.count(F.lit(1)).alias("cnt"), S.avg_round("total", 2, 2).alias("avg_total"))


def verified_counts(t) -> DataFrame:
    """Customers per email_verified."""
    c = table(t, "customers")
    if not has_column(c, "email_verified"):
        c = email_verified(c)
    return c.groupBy("email_verified").agg(F.count(F.lit(1)).alias("cnt"))


def top_customers_by_spend(t, n: int = 5, by: str = "name") -> DataFrame:
    """Order count and ROUND(SUM(total), 2) per customer name, top n.

    ``by='name'`` is the reference (namesakes merge); ``by='id'`` keeps them apart.
    Orders are pre-aggregated per customer id before the join.
    """
    per_cust = (table(t, "orders").groupBy("customer_id")
                .agg(F.count(F.lit(1)).alias("_cnt"), F.sum("total").alias("_sum")))
    c = table(t, "customers").select(F.col("id").alias("customer_id"), "name")
    j = c.join(per_cust, "customer_id")
    keys = ["name"] if by == "name" else ["customer_id", "name"]
    g = j.groupBy(*keys).agg(F.sum("_cnt").alias("order_count"),
                             F.round(F.sum("_sum"), 2).cast("decimal(38,2)").alias("total_spent"))
    return top_k(g, n, F.col("total_spent").desc_nulls_first(), *[F.col(k).asc() for k in keys])


def total_revenue(t, usd: bool = False) -> DataFrame:
    """COALESCE(SUM(total), 0) (mixed currencies, as the reference);
    ``usd=True`` converts each order first (D11b)."""
    if usd:
        o = fk_assign(table(t, "orders"), table(t, "exchange_rates"))
        r = table(t, "exchange_rates").select(F.col("id").alias("currency_id"), "rate_to_usd")
        amt = F.round(F.col("total") * F.col("rate_to_usd"), 2)
        return o.join(r, "currency_id").agg(
            F.coalesce(F.sum(amt), F.lit(0)).cast("decimal(38,2)").alias("revenue_usd"))
    return table(t, "orders").agg(F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(38,2)").alias("revenue"))


def table_counts(t, names: list[str]) -> DataFrame:
    """(table_name, row_count) for each table; one job over a union of
    single-row aggregates."""
    parts = [table(t, n).agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(n).alias("table_name"), "row_count") for n in names]
    return reduce(DataFrame.unionByName, parts)
