"""Registered catalog queries (groups B, C1, C5, D1-D5) with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators import catalog as C
from emporia.plans.registry import register
from emporia.sources.tables import with_sql

_AVG1 = S.half_up_div_sql("_sum", "_n", 1)


ONE_PRODUCT = 40


@register("best_sellers", with_sql(f"""
    SELECT p.id, p.name, p.price, p.category,
           CAST(COALESCE(inv.quantity, 0) AS BIGINT) AS stock,
           CAST(u.units AS BIGINT) AS units_sold,
           CAST(COALESCE({_AVG1}, 0) AS DECIMAL(18,1)) AS avg_rating,
           CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
    FROM (SELECT product_id, SUM(quantity) AS units FROM order_items GROUP BY product_id) u
    JOIN products p ON p.id = u.product_id
    LEFT JOIN (SELECT product_id, SUM(quantity) AS quantity FROM inventory GROUP BY product_id) inv ON inv.product_id = p.id
    LEFT JOIN (SELECT product_id, COUNT(*) AS _n, SUM(rating) AS _sum FROM reviews GROUP BY product_id) r ON r.product_id = p.id
    ORDER BY units_sold DESC, p.id LIMIT 8""", "products", "order_items", "inventory", "reviews"))
def q_best_sellers(t):
    """D4 best sellers, pre-aggregated (default mode)."""
    return C.best_sellers(t, 8, "correct")


@register("best_sellers_exact", with_sql(f"""
    SELECT p.id, p.name, p.price, p.category,
           COALESCE(inv.quantity, 0) AS stock,
           CAST(SUM(oi.quantity) AS BIGINT) AS units_sold,
           CAST(COALESCE({S.avg_round_sql('r.rating', 1)}, 0) AS DECIMAL(18,1)) AS avg_rating,
           CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
    FROM order_items oi
    JOIN products p ON p.id = oi.product_id
    LEFT JOIN inventory inv ON inv.product_id = p.id
    LEFT JOIN reviews r ON r.product_id = p.id
    GROUP BY p.id, p.name, p.price, p.category, inv.quantity
    ORDER BY units_sold DESC, p.id, stock LIMIT 8""", "products", "order_items", "inventory", "reviews"))
def q_best_sellers_exact(t):
    """D4 best sellers with the reference's join fan-out (computed without the fan-out join)."""
    return C.best_sellers(t, 8, "exact")


@register("catalog_listing", with_sql(f"""
    SELECT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock,
           CAST(COALESCE({S.avg_round_sql('r.rating', 1)}, 0) AS DECIMAL(18,1)) AS avg_rating,
           COUNT(r.rating) AS review_count,
           CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
    FROM products p
    LEFT JOIN inventory i ON i.product_id = p.id
    LEFT JOIN reviews r ON r.product_id = p.id
    GROUP BY p.id, p.name, p.price, p.category, i.quantity""", "products", "inventory", "reviews"))
def q_catalog_listing(t):
    """D1 full catalog listing (all pages)."""
    return C.catalog_listing(t, limit=None)


@register("catalog_listing_page", with_sql(f"""
    SELECT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock,
           CAST(COALESCE({S.avg_round_sql('r.rating', 1)}, 0) AS DECIMAL(18,1)) AS avg_rating,
           COUNT(r.rating) AS review_count,
           CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
    FROM products p
    LEFT JOIN inventory i ON i.product_id = p.id
    LEFT JOIN reviews r ON r.product_id = p.id
    WHERE p.category = 'ECONOMY' AND p.name ILIKE '%Ge%'
    GROUP BY p.id, p.name, p.price, p.category, i.quantity
    ORDER BY p.id, stock LIMIT 50 OFFSET 10""", "products", "inventory", "reviews"))
def q_catalog_listing_page(t):
    """D1 with category + search filters and a page (B1, B2)."""
    return C.catalog_listing(t, category="ECONOMY", search="Ge", limit=50, offset=10)


@register("catalog_filter", with_sql("""
    SELECT id, name, price, category FROM products
    WHERE category = 'STANDARD' AND name ILIKE '%R%'""", "products"))
def q_catalog_filter(t):
    """B1 category + ILIKE search."""
    return C.catalog_filter(t.products, "STANDARD", "R")


@register("catalog_page", with_sql("""
    SELECT id, name, price, category FROM products ORDER BY id LIMIT 50 OFFSET 100""", "products"))
def q_catalog_page(t):
    """B2 ORDER BY id LIMIT 50 OFFSET 100."""
    return C.catalog_page(t.products, 50, 100)


@register("adaptive_select", with_sql("""
    SELECT id, name, email, 0 AS loyalty_points, false AS email_verified FROM customers""", "customers"))
def q_adaptive_select(t):
    """B3 optional columns absent -> defaults."""
    return C.adaptive_select(t.customers, ["id", "name", "email"],
                             {"loyalty_points": 0, "email_verified": False})


@register("points_per_product", with_sql("""
    SELECT id, name, price, category, CAST(FLOOR(price) AS INTEGER) AS loyalty_points_earned FROM products""",
                                         "products"))
def q_points_per_product(t):
    """B4 FLOOR(price)::INT."""
    return C.points_per_product(t.products)


@register("in_list", with_sql("""
    SELECT * FROM products WHERE id IN (SELECT product_id FROM cart_events WHERE action = 'add')""",
                              "products", "cart_events"))
def q_in_list(t):
    """B8 id IN (products in any cart) as a left-semi join."""
    keys = t.cart_events.filter(F.col("action") == "add")
    return C.in_list(t.products, keys, "id", "product_id")


@register("stock_status", with_sql(f"""
    SELECT id AS inventory_id, product_id, warehouse, quantity, reorder_level,
           {S.stock_status_sql('quantity', 'reorder_level')} AS stock_status FROM inventory""", "inventory"))
def q_stock_status(t):
    """B10 stock badge per warehouse row."""
    inv = t.inventory.withColumnRenamed("id", "inventory_id")
    return C.stock_status(inv, "quantity", "reorder_level").select(
        "inventory_id", "product_id", "warehouse", "quantity", "reorder_level", "stock_status")


@register("distinct_categories", with_sql("""
    SELECT DISTINCT category FROM products ORDER BY category NULLS LAST""", "products"))
def q_distinct_categories(t):
    """B12 SELECT DISTINCT category."""
    return C.distinct_values(t.products, "category")


@register("name_like", with_sql("""
    SELECT id, name, price, category FROM products WHERE name LIKE '%e%' AND name NOT LIKE '%gear'""",
                                "products"))
def q_name_like(t):
    """B13 LIKE and NOT LIKE."""
    return C.name_like(C.name_like(t.products, "name", "%e%"), "name", "%gear", negate=True)


@register("product_stock", with_sql("""
    SELECT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock, i.warehouse, i.reorder_level
    FROM products p LEFT JOIN inventory i ON i.product_id = p.id""", "products", "inventory"))
def q_product_stock(t):
    """C1 products LEFT JOIN inventory."""
    return C.product_stock(t)


@register("product_reviews", with_sql("""
    SELECT product_id, rn, rating, comment, review_date, reviewer FROM (
      SELECT r.product_id, r.rating, r.comment, r.review_date, c.name AS reviewer,
             CAST(row_number() OVER (PARTITION BY r.product_id
                  ORDER BY r.review_date DESC NULLS FIRST, r.customer_id, r.rating, r.comment) AS INTEGER) AS rn
      FROM reviews r JOIN customers c ON c.id = r.customer_id) WHERE rn <= 20""", "reviews", "customers"))
def q_product_reviews(t):
    """C5 newest 20 reviews per product."""
    return C.product_reviews(t, 20)


@register("product_review_list", with_sql(f"""
    SELECT r.rating, r.comment, r.review_date, c.name AS reviewer FROM reviews r JOIN customers c ON c.id = r.customer_id
    WHERE r.product_id = {ONE_PRODUCT} ORDER BY r.review_date DESC NULLS FIRST, r.customer_id, r.rating, r.comment LIMIT 20""",
                                          "reviews", "customers"))
def q_product_review_list(t):
    """C5 the newest 20 reviews of one product page, with their comments."""
    return C.product_review_list(t, ONE_PRODUCT)


_PROMO_SQL = ("(SELECT product_id, arg_max(badge_text, id) AS badge_text, arg_max(discount_pct, id) AS discount_pct, "
              "arg_max(sale_price, id) AS sale_price FROM promotions WHERE is_active GROUP BY product_id)")


@register("catalog_listing_promos", with_sql(f"""
    SELECT l.*, b.badge_text, b.discount_pct, b.sale_price FROM (
      SELECT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock,
             CAST(COALESCE({S.avg_round_sql('r.rating', 1)}, 0) AS DECIMAL(18,1)) AS avg_rating,
             COUNT(r.rating) AS review_count, CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
      FROM products p LEFT JOIN inventory i ON i.product_id = p.id LEFT JOIN reviews r ON r.product_id = p.id
      GROUP BY p.id, p.name, p.price, p.category, i.quantity) l
    LEFT JOIN {_PROMO_SQL} b ON b.product_id = l.id""", "products", "inventory", "reviews", "promotions"))
def q_catalog_listing_promos(t):
    """D1 + C10 the whole listing with the promo overlay in the same plan."""
    return C.catalog_listing(t, limit=None, with_promos=True)


@register("catalog_listing_bare", with_sql("""
    SELECT DISTINCT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock,
           CAST(0 AS DECIMAL(18,1)) AS avg_rating, CAST(0 AS BIGINT) AS review_count
    FROM products p LEFT JOIN inventory i ON i.product_id = p.id""", "products", "inventory"))
def q_catalog_listing_bare(t):
    """D1 before the reviews, promotions and loyalty tables exist."""
    return C.catalog_listing(t.as_dict("products", "inventory"), limit=None, with_loyalty=False, with_promos=True)


@register("best_sellers_bare", with_sql("""
    SELECT p.id, p.name, p.price, p.category, CAST(COALESCE(inv.quantity, 0) AS BIGINT) AS stock,
           CAST(u.units AS BIGINT) AS units_sold, CAST(0 AS DECIMAL(18,1)) AS avg_rating,
           CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
    FROM (SELECT product_id, SUM(quantity) AS units FROM order_items GROUP BY product_id) u
    JOIN products p ON p.id = u.product_id
    LEFT JOIN (SELECT product_id, SUM(quantity) AS quantity FROM inventory GROUP BY product_id) inv ON inv.product_id = p.id
    ORDER BY units_sold DESC, p.id LIMIT 8""", "products", "order_items", "inventory"))
def q_best_sellers_bare(t):
    """D4 featured products without a reviews table."""
    return C.best_sellers(t.as_dict("products", "order_items", "inventory"), 8)


@register("product_detail_bare", with_sql(f"""
    SELECT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock, i.warehouse, i.reorder_level,
           CAST(0 AS DECIMAL(18,1)) AS avg_rating, CAST(0 AS BIGINT) AS review_count,
           CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
    FROM products p LEFT JOIN inventory i ON i.product_id = p.id WHERE p.id = {ONE_PRODUCT}""", "products", "inventory"))
def q_product_detail_bare(t):
    """Product page without reviews and promotions tables."""
    return C.product_detail(t.as_dict("products", "inventory"), ONE_PRODUCT)


@register("product_rating", with_sql(f"""
    SELECT product_id, CAST(COALESCE({S.avg_round_sql('rating', 1)}, 0) AS DECIMAL(18,1)) AS avg_rating,
           COUNT(*) AS review_count FROM reviews GROUP BY product_id""", "reviews"))
def q_product_rating(t):
    """D2 avg rating (1 dp) and count per product."""
    return C.product_rating(t)


@register("top_rated", with_sql(f"""
    SELECT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock,
           {S.avg_round_sql('r.rating', 1)} AS avg_rating, COUNT(r.rating) AS review_count,
           CAST(FLOOR(p.price) AS INTEGER) AS loyalty_points_earned
    FROM products p LEFT JOIN inventory i ON i.product_id = p.id
    JOIN reviews r ON r.product_id = p.id
    GROUP BY p.id, p.name, p.price, p.category, i.quantity
    HAVING COUNT(r.rating) >= 2
    ORDER BY avg_rating DESC, review_count DESC, p.id, stock LIMIT 8""", "products", "inventory", "reviews"))
def q_top_rated(t):
    """D3 top rated, >= 2 reviews, top 8."""
    return C.top_rated(t, 2, 8)


@register("catalog_counts", with_sql("""
    SELECT COUNT(*) AS total_products, COUNT(DISTINCT category) AS total_categories FROM products""", "products"))
def q_catalog_counts(t):
    """D5 product and category counts."""
    return C.catalog_counts(t)


@register("add_column_default", with_sql("""
    SELECT *, CAST(0 AS INTEGER) AS loyalty_points FROM customers""", "customers"))
def q_add_column_default(t):
    """B15 ADD COLUMN IF NOT EXISTS ... DEFAULT 0 (applied twice = once)."""
    df = C.add_column_default(t.customers, "loyalty_points", "int", 0)
    return C.add_column_default(df, "loyalty_points", "int", 0)


@register("drop_column", with_sql("SELECT id, customer_id, total, order_date, status FROM orders", "orders"))
def q_drop_column(t):
    """B16 DROP COLUMN currency."""
    return C.drop_column(t.orders, "currency")


@register("rename_project", with_sql("""
    SELECT id AS product_number, name AS product, price AS list_price FROM products""", "products"))
def q_rename_project(t):
    """B17 output aliases."""
    return C.rename_project(t.products, {"id": "product_number", "name": "product", "price": "list_price"})


@register("scan_project", with_sql("SELECT id, name, price FROM products", "products"))
def q_scan_project(t):
    """A1 read table, pick columns (pruned in the parquet scan)."""
    return t.products.select("id", "name", "price")




@register("product_detail", with_sql(f"""
    SELECT s.*, r.avg_rating, r.review_count, CAST(FLOOR(s.price) AS INTEGER) AS loyalty_points_earned,
           b.badge_text, b.discount_pct, b.sale_price
    FROM (SELECT p.id, p.name, p.price, p.category, COALESCE(i.quantity, 0) AS stock, i.warehouse, i.reorder_level
          FROM products p LEFT JOIN inventory i ON i.product_id = p.id WHERE p.id = {ONE_PRODUCT}) s
    LEFT JOIN (SELECT {ONE_PRODUCT} AS id, CAST(COALESCE({_AVG1}, 0) AS DECIMAL(18,1)) AS avg_rating,
                      review_count FROM (SELECT COUNT(*) AS review_count, COUNT(*) AS _n, SUM(rating) AS _sum
                                         FROM reviews WHERE product_id = {ONE_PRODUCT})) r ON r.id = s.id
    LEFT JOIN (SELECT product_id, arg_max(badge_text, id) AS badge_text, arg_max(discount_pct, id) AS discount_pct,
                      arg_max(sale_price, id) AS sale_price FROM promotions
               WHERE is_active AND product_id = {ONE_PRODUCT} GROUP BY product_id) b ON b.product_id = s.id""",
                                    "products", "inventory", "reviews", "promotions"))
def q_product_detail(t):
    """Product page: stock per warehouse, points, rating, active promo (C1 + B4 + D2 + C10)."""
    return C.product_detail(t, ONE_PRODUCT)
