"""Cart and checkout as batch jobs over many customers (keys H1-H7).

The reference keeps one in-process cart and checks out one customer per
request. Here carts are folded from an event table and every customer is
priced, validated and checked out in the same set-based plan.

Cart events: (event_id, customer_id, ts, action, product_id, quantity) with
action 'add' | 'update' | 'clear'; events of a customer apply in
(ts, event_id) order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.functions.ids import dense_ids
from emporia.functions.windows import hot_keys, running_sum, salted_join
from emporia.operators.common import table
from emporia.operators.first_come import accept_in_order
from emporia.operators.promos import active_promos


def _order() -> Column:
    return F.struct(F.col("ts"), F.col("event_id"))


def cart_state(events: DataFrame, products: DataFrame) -> DataFrame:
    """H1: final cart lines (customer_id, product_id, quantity > 0).

    Rules: add q (q >= 1, known product) adds q; update q sets q when the item
    is in the cart (q <= 0 or NULL removes it) and is ignored when it is not;
    clear empties the customer's cart.

    Closed form instead of a per-key fold: after the customer's last clear,
    let U be the last update of the item. If there is none the quantity is the
    sum of adds. Otherwise the item is in the cart just before U exactly when
    some add lies after the last non-positive update preceding U, and the
    final quantity is (U applies and q_U > 0 ? q_U : 0) + the adds after U.
    That needs two aggregates and two joins. The aggregates are partial, and
    the joins (events to the customer's last clear, adds to the item's last
    update) are salted for the customers that hold many of the events, so one
    with a third of them is spread over many tasks; nobody else's rows are copied.
    """
    ev = events.select("event_id", "customer_id", "ts", "action", "product_id", "quantity").withColumn(
        "quantity", F.when(F.col("action") == "update", F.coalesce("quantity", F.lit(0))).otherwise(F.col("quantity")))
    last_clear = (ev.filter(F.col("action") == "clear").groupBy("customer_id")
                  .agg(F.max(_order()).alias("_clr")))
    known = products.select(F.col("id").alias("product_id"))
    items = (ev.filter(F.col("action").isin("add", "update"))
             .filter((F.col("action") == "update") | (F.col("quantity") >= 1))
             .join(known, "product_id", "left_semi"))
    hot = hot_keys(ev, ["customer_id"])
    items = (salted_join(items, last_clear, ["customer_id"], hot, F.col("event_id"))
             .withColumn("_o", _order())
             .filter(F.col("_clr").isNull() | (F.col("_o") > F.col("_clr")))
             .drop("_clr"))
    keys = ["customer_id", "product_id"]
    is_upd = F.col("action") == "update"
    upd = (items.groupBy(*keys).agg(
        F.max(F.when(is_upd, F.struct(F.col("_o").alias("o"), F.col("quantity").alias("q")))).alias("_u"),
        F.max(F.when(is_upd & (F.col("quantity") <= 0), F.col("_o"))).alias("_tr"))
        .select(*keys, F.col("_u.o").alias("_tu"), F.col("_u.q").alias("_qu"), "_tr"))
    adds = items.filter(F.col("action") == "add").select(*keys, "_o", "quantity")
    # Keys with updates but no adds end with nothing in the cart, so a left
    # join from the adds suffices.
    j = salted_join(adds, upd, keys, hot, F.col("_o.event_id"))
    after_u = F.col("_tu").isNull() | (F.col("_o") > F.col("_tu"))
    between = (F.col("_o") < F.col("_tu")) & (F.col("_tr").isNull() | (F.col("_o") > F.col("_tr")))
    per = j.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(after_u, F.col("quantity"))), F.lit(0)).alias("_after"),
        F.max(F.when(between, F.lit(1))).alias("_present"),
        F.max("_tu").alias("_tu"),
        F.max("_qu").alias("_qu"))
    base = F.when(F.col("_tu").isNotNull() & (F.col("_present") == 1) & (F.col("_qu") > 0), F.col("_qu")).otherwise(0)
    qty = (base + F.col("_after")).cast("long")
    return per.select(*keys, qty.alias("quantity")).filter(F.col("quantity") > 0)


def _stock_per_product(inventory: DataFrame) -> DataFrame:
    """One stock figure per product: the last inventory row by id (the
    reference keeps whichever row its dict saw last)."""
    return inventory.groupBy("product_id").agg(F.max_by("quantity", "id").alias("stock"))


def _promo_per_product(promos: DataFrame) -> DataFrame:
    return (active_promos(promos).groupBy("product_id")
            .agg(F.max_by(F.struct("sale_price", "badge_text", "discount_pct"), F.col("id")).alias("_p"))
            .select("product_id", F.col("_p.sale_price").alias("sale_price"),
                    F.col("_p.badge_text").alias("badge_text"), F.col("_p.discount_pct").alias("discount_pct")))


def price_cart(cart: DataFrame, t) -> DataFrame:
    """H2: priced cart lines.

    effective price = active promo sale price when set and non-zero, else
    list price; line_total = round(effective * qty, 2); in_stock = stock >= qty;
    points = floor(effective) * qty. Lines of unknown products are skipped.
    Decimal arithmetic throughout (the reference used floats).
    """
    p = table(t, "products").select(F.col("id").alias("product_id"), "name", "price", "category")
    stock = _stock_per_product(table(t, "inventory"))
    promo = _promo_per_product(table(t, "promotions"))
    j = (cart.select("customer_id", "product_id", F.col("quantity").alias("cart_quantity"))
         .join(p, "product_id").join(stock, "product_id", "left").join(promo, "product_id", "left"))
    eff = F.when(F.col("sale_price").isNotNull() & (F.col("sale_price") != 0), F.col("sale_price")) \
        .otherwise(F.col("price")).cast("decimal(18,2)")
    return j.select(
        "customer_id", "product_id", "name", "category", "price",
        F.coalesce(F.col("stock"), F.lit(0)).alias("stock"), "cart_quantity",
        "sale_price", "badge_text", "discount_pct",
        eff.alias("effective_price"),
        F.round(eff * F.col("cart_quantity"), 2).cast("decimal(38,2)").alias("line_total"),
        (F.coalesce(F.col("stock"), F.lit(0)) >= F.col("cart_quantity")).alias("in_stock"),
        (F.floor(eff) * F.col("cart_quantity")).cast("long").alias("loyalty_points_earned"))


def cart_totals(cart: DataFrame, priced: DataFrame, t, members: DataFrame | None = None) -> DataFrame:
    """H3: per customer subtotal (rounded sum of unrounded lines), item_count
    (all cart quantities, unknown products included), points and tier."""
    counts = cart.groupBy("customer_id").agg(F.sum("quantity").cast("long").alias("item_count"))
    money = priced.groupBy("customer_id").agg(
        F.round(F.sum(F.col("effective_price") * F.col("cart_quantity")), 2).cast("decimal(38,2)").alias("subtotal"),
        F.sum("loyalty_points_earned").cast("long").alias("total_points_earned"))
    out = counts.join(money, "customer_id", "left").select(
        "customer_id", F.coalesce("subtotal", F.lit(0).cast("decimal(38,2)")).alias("subtotal"), "item_count",
        F.coalesce("total_points_earned", F.lit(0).cast("long")).alias("total_points_earned"))
    if members is not None:
        c = table(t, "customers").select(F.col("id").alias("customer_id"), "email")
        tiers = members.select("email", F.col("tier").alias("loyalty_tier")).join(c, "email").drop("email")
        out = out.join(tiers, "customer_id", "left")
    return out


def validate_checkout(cart: DataFrame, t, shoppers: DataFrame) -> DataFrame:
    """H4: per shopper: 'empty', or 'rejected' when any line is an unknown
    product or has stock < quantity, else 'ok' (a cart is all or nothing).

    ``shoppers`` lists the customers who have a cart (possibly empty).
    """
    p = table(t, "products").select(F.col("id").alias("product_id"), F.lit(True).alias("_known"))
    stock = _stock_per_product(table(t, "inventory"))
    lines = (cart.join(p, "product_id", "left").join(stock, "product_id", "left")
             .withColumn("_unknown", F.col("_known").isNull())
             .withColumn("_short", F.col("_known").isNotNull() &
                         (F.coalesce(F.col("stock"), F.lit(0)) < F.col("quantity"))))
    per = lines.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("_unknown"), 1)).alias("unknown_lines"),
        F.count(F.when(F.col("_short"), 1)).alias("short_lines"))
    s = shoppers.select("customer_id").distinct()
    j = s.join(per, "customer_id", "left")
    status = (F.when(F.col("lines").isNull(), F.lit("empty"))
              .when((F.col("unknown_lines") > 0) | (F.col("short_lines") > 0), F.lit("rejected"))
              .otherwise(F.lit("ok")))
    reason = (F.when(F.col("lines").isNull(), F.lit("cart is empty"))
              .when(F.col("unknown_lines") > 0, F.lit("product not found"))
              .when(F.col("short_lines") > 0, F.lit("not enough stock")))
    return j.select("customer_id", F.coalesce("lines", F.lit(0)).alias("lines"),
                    F.coalesce("unknown_lines", F.lit(0)).alias("unknown_lines"),
                    F.coalesce("short_lines", F.lit(0)).alias("short_lines"),
                    status.alias("status"), reason.alias("reason"))


def accepted_lines(cart: DataFrame, t, shoppers: DataFrame | None = None) -> DataFrame:
    """Lines of the carts that check out, with the product's list price.

    Carts check out one after the other in (cart time, customer) order (``ts``;
    customer only, if the cart has no time) against the stock that the carts
    before them left; each is all or nothing, and a refused cart uses no stock.
    """
    p = table(t, "products").select(F.col("id").alias("product_id"), "price", "name")
    stock = _stock_per_product(table(t, "inventory"))
    known = (cart.join(p, "product_id", "left").join(stock, "product_id", "left")
             .withColumn("stock", F.when(F.col("price").isNotNull(), F.coalesce("stock", F.lit(0)))))
    if shoppers is not None:
        known = known.join(shoppers.select("customer_id").distinct(), "customer_id", "left_semi")
    order = ["ts", "customer_id"] if "ts" in cart.columns else ["customer_id"]
    return (accept_in_order(known, ["customer_id"], "product_id", order)
            .filter("accepted").drop("accepted", "stock"))


def checkout_points(lines: DataFrame) -> DataFrame:
    """H6: points per customer = sum(int(price) * qty) over accepted lines."""
    return lines.groupBy("customer_id").agg(
        F.sum(F.floor("price") * F.col("quantity")).cast("long").alias("points"))


def conditional_decrement(inventory: DataFrame, demand: DataFrame, order: list[str] | None = None) -> DataFrame:
    """E5: quantity -= n WHERE product_id = p AND quantity >= n, for every
    warehouse row of the product and every line of ``demand`` in ``order``.

    A warehouse row that has too little for a line skips it and may still
    serve a later, smaller one, as the statements would one after the other.
    Without an order (``ts``, ``customer_id``) the demand of a product is one statement.
    """
    order = order or [c for c in ("ts", "customer_id") if c in demand.columns]
    if not order:
        demand = demand.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
        order = ["product_id"]
    rows = inventory.select(F.col("id").alias("_row"), "product_id", F.col("quantity").alias("stock"))
    lines = demand.select(*dict.fromkeys(["product_id", "quantity", *order])).join(rows, "product_id").withColumn(
        "_line", F.struct(*order))
    taken = (accept_in_order(lines, ["_row", "_line"], "_row", order).filter("accepted")
             .groupBy(F.col("_row").alias("id")).agg(F.sum("quantity").alias("_n")))
    j = inventory.join(taken, "id", "left")
    q = F.col("quantity") - F.coalesce("_n", F.lit(0))
    return j.select(*[q.cast(inventory.schema["quantity"].dataType).alias("quantity") if c == "quantity"
                      else F.col(c) for c in inventory.columns])


class CheckoutResult(dict):
    """Outputs of a checkout, built on first access: asking only for the new
    inventory does not assign order ids (which writes an id table)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        value = self._builders[key]()
        self[key] = value
        return value

    def keys(self):
        return self._builders.keys()


def checkout(cart: DataFrame, t, shoppers: DataFrame, at, use_sale_price: bool = False,
             orders_start=None, items_start=None) -> CheckoutResult:
    """H5: check the carts out one after the other (see ``accepted_lines``): one
    pending USD order and one item per line (total = round(price * qty, 2) at
    full price unless ``use_sale_price``), stock decremented (E5), points
    awarded (E6). New ids continue after the current maximum (E7), ordered by
    (customer, product).

    The accepted lines are settled and written once; new 'orders', new
    'order_items', updated 'inventory' and the per-customer 'points' all derive
    from them, each built on first access.
    """
    lines = accepted_lines(cart, t, shoppers)
    keep_order = [c for c in ("ts", "customer_id") if c in lines.columns]
    if use_sale_price:
        promo = _promo_per_product(table(t, "promotions")).select("product_id", "sale_price")
        lines = (lines.join(promo, "product_id", "left")
                 .withColumn("price", F.when(F.col("sale_price").isNotNull() & (F.col("sale_price") != 0),
                                             F.col("sale_price")).otherwise(F.col("price")))
                 .drop("sale_price"))
    total = F.round(F.col("price") * F.col("quantity"), 2).cast("decimal(18,2)")
    memo = {}

    def numbered():
        if "n" not in memo:
            start = orders_start if orders_start is not None else \
                table(t, "orders").select((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("s"))
            memo["n"] = dense_ids(lines.select("customer_id", "product_id", "quantity", "price"),
                                  ["customer_id", "product_id"], "id", start)
        return memo["n"]

    def orders():
        return numbered().select(
            "id", "customer_id", "product_id", "quantity", total.alias("total"),
            F.lit("USD").alias("currency"), F.lit(at).cast("timestamp_ntz").alias("order_date"),
            F.lit("pending").alias("status"))

    def items():
        it = numbered().select(
            F.col("id").alias("order_id"), "product_id", "quantity",
            F.col("price").cast("decimal(18,2)").alias("unit_price"), total.alias("line_total"))
        # Item ids follow order ids one to one: same offset, no second numbering pass.
        start = items_start if items_start is not None else \
            table(t, "order_items").select((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("s"))
        first_order = orders_start if orders_start is not None else \
            table(t, "orders").select((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("s"))
        s_items = F.lit(start) if isinstance(start, int) else start.scalar()
        s_orders = F.lit(first_order) if isinstance(first_order, int) else first_order.scalar()
        return it.select((F.col("order_id") - s_orders + s_items).cast("long").alias("id"), "order_id",
                         "product_id", "quantity", "unit_price", "line_total")

    return CheckoutResult({
        "orders": orders,
        "order_items": items,
        "inventory": lambda: conditional_decrement(
            table(t, "inventory"), lines.select("product_id", "quantity", *keep_order), keep_order),
        "points": lambda: checkout_points(lines),
    })


def allocate_stock(cart: DataFrame, inventory: DataFrame) -> DataFrame:
    """H7: single lines at once, first come first served per product.

    Lines are ordered per product by (cart time, customer). A line is granted
    when it fits into what the lines granted before it left (``remaining``);
    a refused line uses no stock, so a later, smaller one may be granted.
    """
    stock = _stock_per_product(inventory)
    lines = cart.join(stock, "product_id", "left").withColumn("stock", F.coalesce(F.col("stock"), F.lit(0)))
    done = accept_in_order(lines, ["product_id", "customer_id"], "product_id", ["ts", "customer_id"])
    used = running_sum(done, ["product_id"], ["ts", "customer_id"],
                       {"_used": F.when(F.col("accepted"), F.col("quantity")).otherwise(F.lit(0))})
    own = F.when(F.col("accepted"), F.col("quantity")).otherwise(F.lit(0))
    return (used.withColumn("remaining", (F.col("stock") - F.col("_used") + own).cast("long"))
            .withColumnRenamed("accepted", "granted").drop("_used"))
