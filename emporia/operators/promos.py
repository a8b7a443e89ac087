"""Promotion operators. Keys B9, C9, C10, C11, E4."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.operators.common import table, top_k


def active_promos(promos: DataFrame, at=None) -> DataFrame:
    """is_active = true. Like the reference, dates are not checked unless
    ``at`` is given (then start_date <= at < end_date too; ours)."""
    df = promos.filter(F.col("is_active"))
    if at is not None:
        ts = F.lit(at).cast("timestamp_ntz")
        df = df.filter((F.col("start_date") <= ts) & (F.col("end_date") > ts))
    return df


def promo_sale_price(promos: DataFrame, prices: DataFrame, price_col: str = "price",
                     key: str = "id") -> DataFrame:
    """C11: sale_price = ROUND(price * (1 - discount_pct / 100), 2); missing price -> NULL.

    Decimal throughout (the reference turned prices into floats).
    """
    p = prices.select(F.col(key).alias("_pid"), F.col(price_col).cast("decimal(18,2)").alias("_price"))
    factor = (F.lit(1) - F.col("discount_pct") / F.lit(100)).cast("decimal(12,6)")
    return (promos.join(p, F.col("product_id") == F.col("_pid"), "left")
            .withColumn("sale_price", F.round(F.col("_price") * factor, 2).cast("decimal(10,2)"))
            .drop("_pid", "_price"))


def promo_overlay(df: DataFrame, promos: DataFrame, key: str = "id") -> DataFrame:
    """Left-overlay badge_text / discount_pct / sale_price of the active promo.

    One promo per product: the reference keeps whichever row its dict saw
    last (undefined order); ours keeps the greatest promo id (``max_by``).
    """
    best = (active_promos(promos).groupBy("product_id")
            .agg(F.max_by(F.struct("badge_text", "discount_pct", "sale_price"), F.col("id")).alias("_p")))
    return (df.join(best.withColumnRenamed("product_id", key), key, "left")
            .select(*[F.col(c) for c in df.columns],
                    F.col("_p.badge_text").alias("badge_text"),
                    F.col("_p.discount_pct").alias("discount_pct"),
                    F.col("_p.sale_price").alias("sale_price")))


def promo_deals(t, n: int = 8) -> DataFrame:
    """Active promos JOIN products LEFT JOIN inventory, discount desc, top n.

    A product with two active promos (or two warehouses) appears more than
    once, as in the reference; promo id then stock break ties.
    """
    p = table(t, "products")
    pr = active_promos(table(t, "promotions")).select(
        F.col("id").alias("promo_id"), "product_id", "badge_text", "discount_pct", "sale_price")
    # Each promo of an existing product yields at least one row, so the top n
    # rows come from the top n such promos: rank promos first, then join n rows.
    pr = F.broadcast(top_k(pr.join(p.select(F.col("id").alias("product_id")), "product_id", "left_semi"), n,
                           F.col("discount_pct").desc_nulls_first(), F.col("promo_id").asc()))
    inv = (table(t, "inventory").join(pr.select(F.col("product_id")), "product_id", "left_semi")
           .select(F.col("product_id").alias("id"), "quantity"))
    j = (pr.join(p, pr.product_id == p.id).drop("product_id")
         .join(inv, "id", "left"))
    out = j.select("id", "name", "price", "category",
                   F.coalesce(F.col("quantity"), F.lit(0)).alias("stock"),
                   "badge_text", "discount_pct", "sale_price",
                   F.floor("price").cast("int").alias("loyalty_points_earned"), "promo_id")
    return top_k(out, n, F.col("discount_pct").desc_nulls_first(), F.col("promo_id").asc(), F.col("stock").asc())


def set_where(df: DataFrame, cond: Column, assignments: dict[str, Column]) -> DataFrame:
    """UPDATE df SET col = expr, ... WHERE cond.

    All expressions see the old row (SQL UPDATE semantics), so they are
    computed in one projection.
    """
    out = []
    for c in df.columns:
        if c in assignments:
            out.append(F.when(cond, assignments[c]).otherwise(F.col(c)).cast(df.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def reprice_promo(promos: DataFrame, promo_id: int, new_pct: str = "35.00", old_pct: str = "0.20",
                  badge: str = "MEGA DEAL") -> DataFrame:
    """E4 as in the reference: discount 35%, new badge, sale_price rescaled from 20% to 35%."""
    from decimal import Decimal
    new_frac = Decimal(new_pct) / 100
    return set_where(
        promos, F.col("id") == promo_id,
        {"discount_pct": F.lit(Decimal(new_pct)).cast("decimal(5,2)"),
         "badge_text": F.lit(badge),
         "sale_price": F.round(F.col("sale_price") / F.lit(1 - Decimal(old_pct)) * F.lit(1 - new_frac), 2)})
