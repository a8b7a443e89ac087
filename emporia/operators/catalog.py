"""Catalog operators: listing, filters, paging, stock, ratings, best sellers.

Keys B1-B4, B8-B14, C1, C5, D1-D5 of the survey. All functions return lazy
DataFrames; aggregations pre-aggregate before joining wherever the
semantics allow, so the large side (order items, reviews) is reduced map-side
to one row per product before any join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators.common import has_column, has_table, table, top_k


# --- B: projections, filters, paging ---------------------------------------

def catalog_filter(df: DataFrame, category: str = "", search: str = "") -> DataFrame:
    """B1: optional ``category =`` AND ``name ILIKE %search%``; '' means no filter.

    Like the reference, '%' and '_' typed by the user are not escaped.
    """
    if category:
        df = df.filter(F.col("category") == category)
    if search:
        df = df.filter(F.col("name").ilike(f"%{search}%"))
    return df


def catalog_page(df: DataFrame, limit: int = 50, offset: int = 0, order_col: str = "id") -> DataFrame:
    """B2: ORDER BY id LIMIT limit OFFSET offset, limit in 1..200, offset >= 0."""
    if not 1 <= limit <= 200:
        raise ValueError("limit must be in 1..200")
    if offset < 0:
        raise ValueError("offset must be >= 0")
    return df.orderBy(F.col(order_col).asc_nulls_last()).offset(offset).limit(limit)


def adaptive_select(df: DataFrame, columns: list[str], optional: dict[str, object]) -> DataFrame:
    """Select ``columns`` plus each optional column if present, else its default."""
    cols = [F.col(c) for c in columns]
    for name, default in optional.items():
        cols.append(F.col(name) if has_column(df, name) else F.lit(default).alias(name))
    return df.select(*cols)


def points_per_product(df: DataFrame, price_col: str = "price") -> DataFrame:
    """loyalty_points_earned = FLOOR(price)::INT."""
    return df.withColumn("loyalty_points_earned", S.points_for_price(price_col))


def in_list(df: DataFrame, keys: DataFrame | list, col: str = "id", key_col: str | None = None) -> DataFrame:
    """``col IN (keys)``. A key frame becomes a left-semi join (scales with
    the key set); a short literal list stays an ``isin`` filter pushed to the scan."""
    if isinstance(keys, list):
        return df.filter(F.col(col).isin(keys))
    k = key_col or col
    return df.join(keys.select(F.col(k).alias(col)), col, "left_semi")


def stock_status(df: DataFrame, quantity_col: str = "stock", reorder_col: str = "reorder_level") -> DataFrame:
    """Out of Stock (<= 0) / Low Stock (<= reorder level) / In Stock."""
    return df.withColumn("stock_status", S.stock_status(quantity_col, reorder_col))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """SELECT DISTINCT col ORDER BY col (NULL kept, sorted last)."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_last())


def name_like(df: DataFrame, col: str, pattern: str, negate: bool = False) -> DataFrame:
    """LIKE / NOT LIKE."""
    cond = F.col(col).like(pattern)
    return df.filter(~cond if negate else cond)


def top_n_by(df: DataFrame, col: str, n: int = 10, tie: str = "id") -> DataFrame:
    """ORDER BY col DESC LIMIT n (id breaks ties)."""
    return top_k(df, n, F.col(col).desc_nulls_first(), F.col(tie).asc())


def add_column_default(df: DataFrame, col: str, dtype: str, default) -> DataFrame:
    """ADD COLUMN IF NOT EXISTS col dtype DEFAULT default (existing kept)."""
    if has_column(df, col):
        return df
    return df.withColumn(col, F.lit(default).cast(dtype))


def drop_column(df: DataFrame, col: str) -> DataFrame:
    """DROP COLUMN."""
    return df.drop(col)


def rename_project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Project with output aliases, in mapping order."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


# --- C: joins ----------------------------------------------------------------

def product_stock(t) -> DataFrame:
    """Products LEFT JOIN inventory, stock = COALESCE(quantity, 0); one row per warehouse."""
    p = table(t, "products")
    inv = table(t, "inventory").select(
        F.col("product_id").alias("id"), "quantity", "warehouse", "reorder_level")
    return (p.join(inv, "id", "left")
             .select("id", "name", "price", "category",
                     F.coalesce(F.col("quantity"), F.lit(0)).alias("stock"),
                     "warehouse", "reorder_level"))


def _newest_first() -> list[Column]:
    return [F.col("review_date").desc_nulls_first(), F.col("customer_id"), F.col("rating"), F.col("comment")]


def product_reviews(t, n: int = 20) -> DataFrame:
    """Newest ``n`` reviews per product with the reviewer's name.

    Reviews are ranked first: ``row_number() <= n`` is planned with a group
    limit below the shuffle, so a product with a third of all reviews ships
    ``n`` rows per map partition, and only ranked rows meet the customers (a
    review's customer exists, F4).
    """
    c = table(t, "customers").select(F.col("id").alias("customer_id"), F.col("name").alias("reviewer"))
    w = Window.partitionBy("product_id").orderBy(*_newest_first())
    newest = table(t, "reviews").withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
    return (newest.join(c, "customer_id")
            .select("product_id", "rn", "rating", "comment", "review_date", "reviewer"))


def product_review_list(t, product_id, n: int = 20) -> DataFrame:
    """C5 for one product page: its newest ``n`` reviews (none if there is no reviews table)."""
    if not has_table(t, "reviews"):
        return table(t, "products").sparkSession.createDataFrame(
            [], "rating int, comment string, review_date timestamp_ntz, reviewer string")
    c = table(t, "customers").select(F.col("id").alias("customer_id"), F.col("name").alias("reviewer"))
    own = top_k(table(t, "reviews").filter(F.col("product_id") == product_id), n, *_newest_first())
    return (own.join(c, "customer_id").orderBy(*_newest_first())
            .select("rating", "comment", "review_date", "reviewer"))


# --- D: aggregations ---------------------------------------------------------

def product_rating(t) -> DataFrame:
    """Per product COALESCE(ROUND(AVG(rating), 1), 0) and COUNT(*)."""
    r = table(t, "reviews")
    return r.groupBy("product_id").agg(
        F.coalesce(S.avg_round("rating", 1), F.lit(0).cast("decimal(18,1)")).alias("avg_rating"),
        F.count(F.lit(1)).alias("review_count"))


def _stock_rows(t) -> DataFrame:
    """(product_id, quantity, n_rows): warehouse rows per product and quantity."""
    return (table(t, "inventory").groupBy("product_id", "quantity")
            .agg(F.count(F.lit(1)).alias("_wh_rows")))


def _review_totals(t, ids: DataFrame | None = None) -> DataFrame | None:
    """(id, _n, _sum) of the reviews of each product, of some products only with
    ``ids`` (product_id); None if there is no reviews table."""
    if not has_table(t, "reviews"):
        return None
    r = table(t, "reviews")
    if ids is not None:
        r = r.join(ids, "product_id", "left_semi")
    return (r.groupBy(F.col("product_id").alias("id"))
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("rating").alias("_sum")))


def _with_reviews(df: DataFrame, totals: DataFrame | None) -> DataFrame:
    if totals is None:
        return df.withColumns({"_n": F.lit(None).cast("long"), "_sum": F.lit(None).cast("long")})
    return df.join(totals, "id", "left")


def _average() -> Column:
    return F.coalesce(S.half_up_div(F.col("_sum"), F.col("_n"), 1).cast("decimal(18,1)"), F.lit(0).cast("decimal(18,1)"))


def catalog_listing(t, category: str = "", search: str = "", limit: int | None = 50, offset: int = 0,
                    with_loyalty: bool = True, with_promos: bool = False) -> DataFrame:
    """Products + stock + avg rating + review count, as the storefront lists them.

    Grouped by product *and inventory quantity*, like the reference: a product
    stocked in two warehouses with different quantities lists twice; with equal
    quantities once, with its review count multiplied by the number of such
    warehouse rows (the join fan-out). Computed from per-product review
    aggregates instead of joining every review to every warehouse row.

    The listing adapts: without a reviews table the ratings and counts are 0,
    and with ``with_promos`` the active promo (C10) is laid over in the same
    plan, if there is a promotions table. ``limit=None`` returns the whole listing.
    """
    p = catalog_filter(table(t, "products"), category, search)
    inv_rows, ids = table(t, "inventory"), None
    if limit is not None:
        # Each product lists at least once, so a page lies within the first
        # offset + limit products by id: only those are joined.
        p = top_k(p, offset + limit, F.col("id").asc())
        ids = p.select(F.col("id").alias("product_id"))
        inv_rows = inv_rows.join(ids, "product_id", "left_semi")
    inv = (inv_rows.groupBy(F.col("product_id").alias("id"), "quantity").agg(F.count(F.lit(1)).alias("_wh_rows")))
    j = _with_reviews(p.join(inv, "id", "left"), _review_totals(t, ids))
    fan = F.coalesce(F.col("_wh_rows"), F.lit(1))
    cnt = (F.coalesce(F.col("_n"), F.lit(0)) * fan).cast("long")
    cols = [F.col("id"), F.col("name"), F.col("price"), F.col("category"),
            F.coalesce(F.col("quantity"), F.lit(0)).alias("stock"),
            _average().alias("avg_rating"), cnt.alias("review_count")]
    if with_loyalty:
        cols.append(S.points_for_price("price").alias("loyalty_points_earned"))
    out = j.select(*cols)
    if with_promos and has_table(t, "promotions"):
        from emporia.operators.promos import promo_overlay
        promos = table(t, "promotions")
        out = promo_overlay(out, promos if ids is None else promos.join(ids, "product_id", "left_semi"))
    if limit is None:
        return out
    return out.orderBy("id", "stock").offset(offset).limit(limit)


def top_rated(t, min_reviews: int = 2, n: int = 8) -> DataFrame:
    """D3: products with >= min_reviews reviews, by avg rating then count, top n.

    Inner join to reviews, grouped by product and inventory quantity (as D1),
    HAVING count >= min_reviews; id breaks remaining ties.
    """
    p = table(t, "products")
    inv = _stock_rows(t).withColumnRenamed("product_id", "id")
    rv = (table(t, "reviews").groupBy("product_id")
          .agg(F.count(F.lit(1)).alias("_n"), F.sum("rating").alias("_sum"))
          .withColumnRenamed("product_id", "id"))
    j = p.join(rv, "id").join(inv, "id", "left")
    cnt = (F.col("_n") * F.coalesce(F.col("_wh_rows"), F.lit(1))).cast("long")
    out = j.select(
        "id", "name", "price", "category",
        F.coalesce(F.col("quantity"), F.lit(0)).alias("stock"),
        S.half_up_div(F.col("_sum"), F.col("_n"), 1).cast("decimal(18,1)").alias("avg_rating"),
        cnt.alias("review_count"),
        S.points_for_price("price").alias("loyalty_points_earned"),
    ).filter(F.col("review_count") >= min_reviews)
    return top_k(out, n, F.col("avg_rating").desc_nulls_first(), F.col("review_count").desc(),
                 F.col("id").asc(), F.col("stock").asc())


def best_sellers(t, n: int = 8, mode: str = "correct") -> DataFrame:
    """Best-selling products by units sold, top ``n``.

    mode='correct' (default): units = SUM(order_items.quantity) per product,
    stock = total over warehouses, one row per product.

    mode='exact': the reference result. Its SQL joins reviews and warehouse
    rows before SUM, so units are multiplied by max(#reviews, 1) and by the
    number of warehouse rows sharing the grouped quantity. The same numbers
    are computed here from per-product aggregates, without the fan-out join.

    Either way order items are reduced to one row per product map-side before
    any join, and the top ``n`` is a TakeOrderedAndProject. Without a reviews
    table the ratings are 0.
    """
    p = table(t, "products")
    units = (table(t, "order_items").groupBy("product_id")
             .agg(F.sum("quantity").alias("_units"))
             .withColumnRenamed("product_id", "id"))
    avg = _average()
    if mode == "exact":
        inv = _stock_rows(t).withColumnRenamed("product_id", "id")
        j = _with_reviews(units.join(p, "id").join(inv, "id", "left"), _review_totals(t))
        sold = (F.col("_units") * F.greatest(F.coalesce(F.col("_n"), F.lit(0)), F.lit(1))
                * F.coalesce(F.col("_wh_rows"), F.lit(1))).cast("long")
        stock = F.coalesce(F.col("quantity"), F.lit(0))
    elif mode == "correct":
        # The ranking needs only (units, id): take the top n of the unit
        # aggregate first (products it sells must exist: semi join), then join
        # just those n rows. Every later join is a broadcast bounded by n, and
        # reviews / inventory are filtered to n products before aggregating.
        top = F.broadcast(top_k(units.join(p.select("id"), "id", "left_semi"), n,
                                F.col("_units").desc_nulls_first(), F.col("id").asc()))
        ids = top.select(F.col("id").alias("product_id"))
        inv = (table(t, "inventory").join(ids, "product_id", "left_semi").groupBy("product_id")
               .agg(F.sum("quantity").alias("quantity"))
               .withColumnRenamed("product_id", "id"))
        j = _with_reviews(top.join(p, "id").join(inv, "id", "left"), _review_totals(t, ids))
        sold = F.col("_units").cast("long")
        stock = F.coalesce(F.col("quantity"), F.lit(0)).cast("long")
    else:
        raise ValueError("mode must be 'correct' or 'exact'")
    out = j.select("id", "name", "price", "category", stock.alias("stock"),
                   sold.alias("units_sold"), avg.alias("avg_rating"),
                   S.points_for_price("price").alias("loyalty_points_earned"))
    return top_k(out, n, F.col("units_sold").desc_nulls_first(), F.col("id").asc(), F.col("stock").asc())


def catalog_counts(t) -> DataFrame:
    """count(*) and count(DISTINCT category) (NULL not counted) of products."""
    p = table(t, "products")
    return p.agg(F.count(F.lit(1)).alias("total_products"),
                 F.countDistinct("category").alias("total_categories"))


def leads_high_quality(leads: DataFrame, quality: str = "High") -> DataFrame:
    """SELECT company, industry, notes FROM customer_leads WHERE lead_quality = quality."""
    return leads.filter(F.col("lead_quality") == quality).select("company", "industry", "notes")


def stock_by_product(t) -> DataFrame:
    """Quantity and reserved summed over warehouses; available = quantity - reserved."""
    inv = table(t, "inventory")
    return inv.groupBy("product_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("reserved").alias("reserved"),
        F.count(F.lit(1)).alias("warehouses"),
    ).withColumn("available", F.col("quantity") - F.col("reserved"))


def product_detail(t, product_id) -> DataFrame:
    """Product page: the product with each warehouse's stock (C1), points (B4),
    its rating and review count (D2) and, if there are promotions, the active
    promo (C10). Its reviews are ``product_review_list``."""
    from emporia.operators.promos import promo_overlay
    stock = product_stock(t).filter(F.col("id") == product_id)
    totals = None
    if has_table(t, "reviews"):
        # Grouped by product and joined on the column (a literal key would let the
        # optimizer drop the join condition and plan a nested-loop join).
        totals = _review_totals({"reviews": table(t, "reviews").filter(F.col("product_id") == product_id)})
    out = (_with_reviews(stock, totals)
           .withColumn("avg_rating", _average())
           .withColumn("review_count", F.coalesce(F.col("_n"), F.lit(0)).cast("long"))
           .withColumn("loyalty_points_earned", S.points_for_price("price"))
           .drop("_n", "_sum"))
    if not has_table(t, "promotions"):
        return out
    return promo_overlay(out, table(t, "promotions").filter(F.col("product_id") == product_id))
