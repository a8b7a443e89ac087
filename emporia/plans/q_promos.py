"""Registered promotion queries."""

from __future__ import annotations


from emporia.functions import scalars as S
from emporia.operators import catalog as C
from emporia.operators import promos as P
from emporia.plans.registry import register
from emporia.sources.tables import with_sql

AT = "2024-03-20 00:00:00"
REPRICED_ID = 80


@register("active_promos", with_sql("SELECT * FROM promotions WHERE is_active", "promotions"))
def q_active_promos(t):
    """B9 is_active = true (dates not checked, as the reference)."""
    return P.active_promos(t.promotions)


@register("active_promos_at", with_sql(f"""
    SELECT * FROM promotions WHERE is_active AND start_date <= TIMESTAMP '{AT}' AND end_date > TIMESTAMP '{AT}'""",
                                       "promotions"))
def q_active_promos_at(t):
    """B9 with the date window checked at a given time."""
    return P.active_promos(t.promotions, AT)


@register("promo_sale_price", with_sql("SELECT * FROM promotions", "promotions"))
def q_promo_sale_price(t):
    """C11 sale_price = ROUND(price * (1 - discount/100), 2) from product prices."""
    return P.promo_sale_price(t.promotions_raw, t.products)


@register("promo_overlay", with_sql("""
    SELECT p.*, b.badge_text, b.discount_pct, b.sale_price FROM products p LEFT JOIN (
      SELECT product_id, arg_max(badge_text, id) AS badge_text, arg_max(discount_pct, id) AS discount_pct,
             arg_max(sale_price, id) AS sale_price FROM promotions WHERE is_active GROUP BY product_id
    ) b ON b.product_id = p.id""", "products", "promotions"))
def q_promo_overlay(t):
    """C10 overlay of the active promo on every product."""
    return P.promo_overlay(t.products, t.promotions)


@register("promo_deals", with_sql("""
    SELECT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock,
           pr.badge_text, pr.discount_pct, pr.sale_price, CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned,
           pr.id AS promo_id
    FROM promotions pr JOIN products p ON p.id = pr.product_id
    LEFT JOIN inventory i ON i.product_id = p.id
    WHERE pr.is_active ORDER BY pr.discount_pct DESC, pr.id, stock LIMIT 8""", "promotions", "products", "inventory"))
def q_promo_deals(t):
    """C9 top 8 active deals by discount."""
    return P.promo_deals(t, 8)


@register("set_where", with_sql(f"""
    SELECT id, product_id,
           CASE WHEN id = {REPRICED_ID} THEN 'MEGA DEAL' ELSE badge_text END AS badge_text,
           CASE WHEN id = {REPRICED_ID} THEN CAST(35.00 AS DECIMAL(5,2)) ELSE discount_pct END AS discount_pct,
           CASE WHEN id = {REPRICED_ID} THEN CAST(ROUND(sale_price / 0.80 * 0.65, 2) AS DECIMAL(10,2))
                ELSE sale_price END AS sale_price,
           promo_type, is_active, start_date, end_date FROM promotions""", "promotions"))
def q_set_where(t):
    """E4 UPDATE promotions SET discount 35%, badge, rescaled sale price WHERE id."""
    return P.reprice_promo(t.promotions, REPRICED_ID)


@register("best_sellers_with_promos", with_sql(f"""
    SELECT bs.*, b.badge_text, b.discount_pct, b.sale_price FROM (
      SELECT p.id, p.name, p.price, p.category, CAST(COALESCE(inv.quantity, 0) AS BIGINT) AS stock,
             CAST(u.units AS BIGINT) AS units_sold,
             CAST(COALESCE({S.half_up_div_sql('_sum', '_n', 1)}, 0) AS DECIMAL(18,1)) AS avg_rating,
             CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
      FROM (SELECT product_id, SUM(quantity) AS units FROM order_items GROUP BY product_id) u
      JOIN products p ON p.id = u.product_id
      LEFT JOIN (SELECT product_id, SUM(quantity) AS quantity FROM inventory GROUP BY product_id) inv ON inv.product_id = p.id
      LEFT JOIN (SELECT product_id, COUNT(*) AS _n, SUM(rating) AS _sum FROM reviews GROUP BY product_id) r ON r.product_id = p.id
      ORDER BY units_sold DESC, p.id LIMIT 8) bs
    LEFT JOIN (SELECT product_id, arg_max(badge_text, id) AS badge_text, arg_max(discount_pct, id) AS discount_pct,
                      arg_max(sale_price, id) AS sale_price FROM promotions WHERE is_active GROUP BY product_id) b
      ON b.product_id = bs.id""", "products", "order_items", "inventory", "reviews", "promotions"))
def q_best_sellers_with_promos(t):
    """D4 + C10: the storefront's featured best sellers with the promo overlay."""
    return P.promo_overlay(C.best_sellers(t, 8, "correct"), t.promotions)
