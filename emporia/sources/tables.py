"""Retail tables derived from the TPC-H-shaped test data.

Each adapter is a pure projection/filter/join over the given parquet tables,
so Catalyst prunes columns and pushes filters into the scans. Every adapter
has a DuckDB SQL twin in ``SQL`` (same expression) used by the oracle.

``Tables(spark, sf_dir)`` exposes the retail model lazily: nothing is read
until an operator asks for a table, and each table is one plan fragment.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions import scalars as S

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for right results.
# Exchange rates (code, name, rate to USD), ids 1..8 in this order.
EXCHANGE_RATES = [
    ("USD", "US Dollar", "1.000000"),
    ("EUR", "Euro", "1.085000"),
    ("GBP", "British Pound", "1.265000"),
    ("JPY", "Japanese Yen", "0.006700"),
    ("AED", "UAE Dirham", "0.272300"),
    ("INR", "Indian Rupee", "0.012000"),
    ("BRL", "Brazilian Real", "0.200000"),
    ("CNY", "Chinese Yuan", "0.138000"),
]
# Badge texts used by promotions.
BADGES = ["SPRING SALE", "HOT DEAL", "CLEARANCE", "LIMITED TIME", "FLASH SALE", "MEGA DEAL"]
# Warehouses.
WAREHOUSES = ["US-EAST", "US-WEST", "EU-WEST", "APAC"]
# TD status letter -> retail status.
STATUS_MAP = {"F": "delivered", "O": "pending", "P": "confirmed"}
# ---------------------------------------------------------------------------

CURRENCIES = [r[0] for r in EXCHANGE_RATES]
PROMO_EPOCH = "2024-03-01 00:00:00"

TD_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
             "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_td(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# ---------------------------------------------------------------------------
# Spark adapters (raw TD frame(s) -> retail frame)

def customers_from(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_id"),
    )


def products_from(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        S.money("p_retailprice").alias("price"),
        F.col("p_type").alias("category"),
    )


def _status(c: str) -> Column:
    expr = None
    for k, v in STATUS_MAP.items():
        expr = F.when(F.col(c) == k, F.lit(v)) if expr is None else expr.when(F.col(c) == k, F.lit(v))
    return expr


def orders_from(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        S.money("o_totalprice").alias("total"),
        F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]),
                     (F.pmod(F.col("o_custkey"), F.lit(8)) + 1).cast("int")).alias("currency"),
        F.col("o_orderdate").alias("order_date"),
        _status("o_orderstatus").alias("status"),
    )


ITEM_ORDER = ["product_id", "_line", "_supp", "line_total", "quantity",
              "_disc", "_tax", "_flag", "_lstatus", "_ship"]
#: An item's id is its order's id times this plus its place in the order (ties are equal rows).
ITEMS_PER_ORDER = 1000


def order_items_from(lineitem: DataFrame, with_id: bool = False) -> DataFrame:
    """Order items; ``with_id`` adds an item id that needs no global numbering.

    The ids follow (order, place in the order), so they are numbered within
    each order: nothing is written, and a filter on the order reaches the scan.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    qty = F.col("l_quantity").cast("long")
    df = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        S.half_up_div(cents, qty, 2).cast("decimal(18,2)").alias("unit_price"),
        S.money("l_extendedprice").alias("line_total"),
        *([F.col("l_linenumber").alias("_line"), F.col("l_suppkey").alias("_supp"),
           F.col("l_discount").alias("_disc"), F.col("l_tax").alias("_tax"),
           F.col("l_returnflag").alias("_flag"), F.col("l_linestatus").alias("_lstatus"),
           F.col("l_shipdate").alias("_ship")] if with_id else []),
    )
    if not with_id:
        return df
    place = F.row_number().over(Window.partitionBy("order_id").orderBy(*ITEM_ORDER))
    return df.select((F.col("order_id") * ITEMS_PER_ORDER + place).cast("long").alias("id"), "order_id", "product_id",
                     "quantity", "unit_price", "line_total")


def inventory_from(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    wh = F.element_at(F.array(*[F.lit(w) for w in WAREHOUSES[:3]]), (F.pmod(pk, F.lit(3)) + 1).cast("int"))
    main = part.select(
        (pk * 2).alias("id"),
        pk.alias("product_id"),
        wh.alias("warehouse"),
        F.pmod(pk, F.lit(200)).cast("int").alias("quantity"),
        (5 * (1 + F.pmod(pk, F.lit(4)))).cast("int").alias("reorder_level"),
        F.least(F.pmod(pk, F.lit(5)), F.pmod(pk, F.lit(200))).cast("int").alias("reserved"),
    )
    second = part.filter(F.pmod(pk, F.lit(10)) == 0).select(
        (pk * 2 + 1).alias("id"),
        pk.alias("product_id"),
        F.lit(WAREHOUSES[3]).alias("warehouse"),
        F.pmod(pk * 7, F.lit(50)).cast("int").alias("quantity"),
        F.lit(10).cast("int").alias("reorder_level"),
        F.lit(0).cast("int").alias("reserved"),
    )
    return main.unionByName(second)


def reviews_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", "l_partkey", "l_shipdate")
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey"))
    return li.join(o, "l_orderkey").select(
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        (1 + F.pmod(F.col("l_orderkey") + F.col("l_partkey"), F.lit(5))).cast("int").alias("rating"),
        F.concat(F.lit("order "), F.col("l_orderkey").cast("string"), F.lit(" returned")).alias("comment"),
        F.col("l_shipdate").alias("review_date"),
    )


def promotions_raw_from(part: DataFrame) -> DataFrame:
    """Promotions without sale price (as seeded); see ``operators.promos.promo_sale_price``."""
    pk = F.col("p_partkey")
    start = F.lit(PROMO_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.pmod(pk, F.lit(30)).cast("int"))
    badge = lambda k: F.element_at(F.array(*[F.lit(b) for b in BADGES]), (F.pmod(k, F.lit(6)) + 1).cast("int"))
    first = part.filter(F.pmod(pk, F.lit(4)) == 0).select(
        (pk * 2).alias("id"),
        pk.alias("product_id"),
        badge(pk).alias("badge_text"),
        (10 + F.pmod(pk, F.lit(51))).cast("decimal(5,2)").alias("discount_pct"),
        F.lit(None).cast("decimal(10,2)").alias("sale_price"),
        F.lit("percentage").alias("promo_type"),
        (F.pmod(pk, F.lit(8)) == 0).alias("is_active"),
        start.alias("start_date"),
        (start + F.make_dt_interval(F.lit(14))).alias("end_date"),
    )
    second = part.filter(F.pmod(pk, F.lit(40)) == 0).select(
        (pk * 2 + 1).alias("id"),
        pk.alias("product_id"),
        badge(pk + 1).alias("badge_text"),
        (5 + F.pmod(pk, F.lit(31))).cast("decimal(5,2)").alias("discount_pct"),
        F.lit(None).cast("decimal(10,2)").alias("sale_price"),
        F.lit("percentage").alias("promo_type"),
        (F.pmod(pk, F.lit(80)) == 0).alias("is_active"),
        start.alias("start_date"),
        (start + F.make_dt_interval(F.lit(7))).alias("end_date"),
    )
    return first.unionByName(second)


LEAD_HIGH, LEAD_MEDIUM = 5000, 0


def customer_leads_from(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Sales leads: one per customer; industry = market segment, state = nation,
    lead_quality High (balance > 5000) / Medium (> 0) / Low."""
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
    bal = F.col("c_acctbal")
    quality = F.when(bal > LEAD_HIGH, F.lit("High")).when(bal > LEAD_MEDIUM, F.lit("Medium")).otherwise(F.lit("Low"))
    return customer.join(n, "c_nationkey", "left").select(
        F.col("c_custkey").alias("lead_id"),
        F.col("c_name").alias("company"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("industry"),
        F.col("state"),
        quality.alias("lead_quality"),
        F.concat(F.lit("segment "), F.col("c_mktsegment"), F.lit(", balance "),
                 F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("notes"),
    )


EXCHANGE_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("currency_code", T.StringType(), False),
    T.StructField("currency_name", T.StringType(), False),
    T.StructField("rate_to_usd", T.DecimalType(12, 6), False),
])


def exchange_rates(spark: SparkSession) -> DataFrame:
    """A2: literal rows as a table (8 rows; broadcast-safe by construction)."""
    from decimal import Decimal
    rows = [(i + 1, c, n, Decimal(r)) for i, (c, n, r) in enumerate(EXCHANGE_RATES)]
    return spark.createDataFrame(rows, EXCHANGE_SCHEMA)


def cart_events_from(events: DataFrame, part: DataFrame) -> DataFrame:
    """Cart actions from the event stream: click=add, purchase=update, error=clear.

    product = event_id % (number of parts); the part count is a scalar
    subquery (one aggregate job), not a join.
    """
    n_parts = part.select(F.count(F.lit(1))).scalar()
    action = (F.when(F.col("event_type") == "click", F.lit("add"))
              .when(F.col("event_type") == "purchase", F.lit("update"))
              .when(F.col("event_type") == "error", F.lit("clear")))
    return (events.filter(F.col("event_type").isin("click", "purchase", "error"))
            .select(
                F.col("event_id"),
                F.col("user_id").alias("customer_id"),
                F.col("ts"),
                action.alias("action"),
                F.when(F.col("event_type") != "error", F.pmod(F.col("event_id"), n_parts)).alias("product_id"),
                F.when(F.col("event_type") != "error",
                       (1 + F.pmod(F.floor("value"), F.lit(5))).cast("int")).alias("quantity"),
            ))


CHANGE_KINDS = [("insert", 0, 0), ("update_postimage", 1, 40), ("delete", 2, 75)]
VERSION_EPOCH_YEAR = 1995


def order_changes_from(orders: DataFrame) -> DataFrame:
    """Change feed of the retail orders table.

    insert at the order date; update (status shipped, total +5%) 40 days later
    for id % 3 = 0; delete 75 days later for id % 17 = 0. Version = month index
    of the commit time since 1995-01; ``_seq`` orders changes inside a version.
    """
    made = []
    for kind, seq, days in CHANGE_KINDS:
        status, total, has = F.col("status"), F.col("total"), F.lit(True)
        if kind == "update_postimage":
            status, has = F.lit("shipped"), F.pmod("id", F.lit(3)) == 0
            total = F.round(F.col("total") * F.lit(1.05).cast("decimal(3,2)"), 2).cast("decimal(18,2)")
        elif kind == "delete":
            has = F.pmod("id", F.lit(17)) == 0
        ts = F.col("order_date") + F.make_dt_interval(F.lit(days))
        made.append(F.when(has, F.struct(
            total.alias("total"), status.alias("status"), F.lit(kind).alias("_change_type"),
            ((F.year(ts) - VERSION_EPOCH_YEAR) * 12 + F.month(ts) - 1).cast("long").alias("_commit_version"),
            ts.alias("_commit_ts"), F.lit(seq).alias("_seq"))))
    # One scan of orders; each order yields its one to three change rows.
    return (orders_from(orders).withColumn("_c", F.explode(F.array_compact(F.array(*made))))
            .select("id", "customer_id", "_c.total", "currency", "order_date", "_c.status", "_c._change_type",
                    "_c._commit_version", "_c._commit_ts", "_c._seq"))


def query_log_from(events: DataFrame) -> DataFrame:
    """Query/activity log: one statement per event.

    query text = 'SELECT * FROM <event_type> WHERE amount = <value in cents>';
    duration_ms = value; status 'Error' for error events else 'OK';
    operation: signup/purchase insert, click update, error delete, view select;
    cache_hit (reads only): the value's cents are not a multiple of 100.
    """
    cents = F.floor(F.col("value") * 100).cast("long").cast("string")
    op = (F.when(F.col("event_type").isin("signup", "purchase"), F.lit("insert"))
          .when(F.col("event_type") == "click", F.lit("update"))
          .when(F.col("event_type") == "error", F.lit("delete"))
          .otherwise(F.lit("select")))
    return events.select(
        F.col("event_id").alias("query_id"),
        F.col("ts"),
        F.col("user_id"),
        F.concat(F.lit("SELECT * FROM "), F.col("event_type"), F.lit(" WHERE amount = "), cents).alias("query"),
        F.col("value").alias("duration_ms"),
        F.when(F.col("event_type") == "error", F.lit("Error")).otherwise(F.lit("OK")).alias("status"),
        op.alias("operation"),
        F.col("event_type"),
        F.col("value"),
        F.when(op == "select", F.pmod(F.floor(F.col("value") * 100), F.lit(100)) != 0).alias("cache_hit"),
    )


# ---------------------------------------------------------------------------
# DuckDB twins (same expressions) for the oracle SQL.

def _status_sql(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in STATUS_MAP.items()) + " END"


_ITEM_ORDER_SQL = ("l_partkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, "
                   "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

SQL: dict[str, str] = {
    "customers": ("SELECT c_custkey AS id, c_name AS name, lower(c_name) || '@example.com' AS email, "
                  "c_mktsegment AS segment, c_nationkey AS nation_id FROM customer"),
    "products": ("SELECT p_partkey AS id, p_name AS name, CAST(p_retailprice AS DECIMAL(18,2)) AS price, "
                 "p_type AS category FROM part"),
    "orders": (f"SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS total, "
               f"{_sql_list(CURRENCIES)}[(o_custkey % 8) + 1] AS currency, o_orderdate AS order_date, "
               f"{_status_sql('o_orderstatus')} AS status FROM orders"),
    "order_items": ("SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity, "
                    f"CAST({S.half_up_div_sql('CAST(ROUND(l_extendedprice * 100) AS BIGINT)', 'CAST(l_quantity AS BIGINT)', 2)} AS DECIMAL(18,2)) AS unit_price, "
                    "CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total FROM lineitem"),
    "order_items_ided": (f"SELECT CAST(l_orderkey * {ITEMS_PER_ORDER} + row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ITEM_ORDER_SQL}) AS BIGINT) AS id, "
                         "l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity, "
                         f"CAST({S.half_up_div_sql('CAST(ROUND(l_extendedprice * 100) AS BIGINT)', 'CAST(l_quantity AS BIGINT)', 2)} AS DECIMAL(18,2)) AS unit_price, "
                         "CAST(l_extendedprice AS DECIMAL(18,2)) AS line_total FROM lineitem"),
    "inventory": (f"SELECT p_partkey * 2 AS id, p_partkey AS product_id, {_sql_list(WAREHOUSES[:3])}[(p_partkey % 3) + 1] AS warehouse, "
                  "CAST(p_partkey % 200 AS INTEGER) AS quantity, CAST(5 * (1 + p_partkey % 4) AS INTEGER) AS reorder_level, "
                  "CAST(least(p_partkey % 5, p_partkey % 200) AS INTEGER) AS reserved FROM part "
                  f"UNION ALL SELECT p_partkey * 2 + 1, p_partkey, '{WAREHOUSES[3]}', CAST((p_partkey * 7) % 50 AS INTEGER), "
                  "CAST(10 AS INTEGER), CAST(0 AS INTEGER) FROM part WHERE p_partkey % 10 = 0"),
    "reviews": ("SELECT l.l_partkey AS product_id, o.o_custkey AS customer_id, "
                "CAST(1 + (l.l_orderkey + l.l_partkey) % 5 AS INTEGER) AS rating, "
                "'order ' || l.l_orderkey || ' returned' AS comment, l.l_shipdate AS review_date "
                "FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_returnflag = 'R'"),
    "promotions_raw": (
        f"SELECT p_partkey * 2 AS id, p_partkey AS product_id, {_sql_list(BADGES)}[(p_partkey % 6) + 1] AS badge_text, "
        "CAST(10 + p_partkey % 51 AS DECIMAL(5,2)) AS discount_pct, CAST(NULL AS DECIMAL(10,2)) AS sale_price, "
        "'percentage' AS promo_type, (p_partkey % 8 = 0) AS is_active, "
        f"TIMESTAMP '{PROMO_EPOCH}' + to_days(CAST(p_partkey % 30 AS INTEGER)) AS start_date, "
        f"TIMESTAMP '{PROMO_EPOCH}' + to_days(CAST(p_partkey % 30 AS INTEGER)) + INTERVAL 14 DAY AS end_date "
        "FROM part WHERE p_partkey % 4 = 0 "
        f"UNION ALL SELECT p_partkey * 2 + 1, p_partkey, {_sql_list(BADGES)}[((p_partkey + 1) % 6) + 1], "
        "CAST(5 + p_partkey % 31 AS DECIMAL(5,2)), CAST(NULL AS DECIMAL(10,2)), 'percentage', (p_partkey % 80 = 0), "
        f"TIMESTAMP '{PROMO_EPOCH}' + to_days(CAST(p_partkey % 30 AS INTEGER)), "
        f"TIMESTAMP '{PROMO_EPOCH}' + to_days(CAST(p_partkey % 30 AS INTEGER)) + INTERVAL 7 DAY "
        "FROM part WHERE p_partkey % 40 = 0"),
    "exchange_rates": ("SELECT CAST(id AS INTEGER) AS id, currency_code, currency_name, CAST(rate_to_usd AS DECIMAL(12,6)) AS rate_to_usd "
                       "FROM (VALUES " + ", ".join(f"({i + 1}, '{c}', '{n}', {r})" for i, (c, n, r) in enumerate(EXCHANGE_RATES))
                       + ") v(id, currency_code, currency_name, rate_to_usd)"),
    "cart_events": (
        "SELECT event_id, user_id AS customer_id, ts, "
        "CASE event_type WHEN 'click' THEN 'add' WHEN 'purchase' THEN 'update' WHEN 'error' THEN 'clear' END AS action, "
        "CASE WHEN event_type <> 'error' THEN event_id % (SELECT count(*) FROM part) END AS product_id, "
        "CASE WHEN event_type <> 'error' THEN CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS INTEGER) END AS quantity "
        "FROM events WHERE event_type IN ('click', 'purchase', 'error')"),
    "customer_leads": (
        "SELECT c.c_custkey AS lead_id, c.c_name AS company, lower(c.c_name) || '@example.com' AS email, "
        "c.c_mktsegment AS industry, n.n_name AS state, "
        "CASE WHEN c.c_acctbal > 5000 THEN 'High' WHEN c.c_acctbal > 0 THEN 'Medium' ELSE 'Low' END AS lead_quality, "
        "'segment ' || c.c_mktsegment || ', balance ' || CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS notes "
        "FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey"),
    "query_log": (
        "SELECT event_id AS query_id, ts, user_id, "
        "'SELECT * FROM ' || event_type || ' WHERE amount = ' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS query, "
        "value AS duration_ms, CASE WHEN event_type = 'error' THEN 'Error' ELSE 'OK' END AS status, "
        "CASE WHEN event_type IN ('signup', 'purchase') THEN 'insert' WHEN event_type = 'click' THEN 'update' "
        "WHEN event_type = 'error' THEN 'delete' ELSE 'select' END AS operation, event_type, value, "
        "CASE WHEN event_type NOT IN ('signup', 'purchase', 'click', 'error') "
        "THEN CAST(floor(value * 100) AS BIGINT) % 100 <> 0 END AS cache_hit FROM events"),
}


def _order_changes_sql() -> str:
    parts = []
    for kind, seq, days in CHANGE_KINDS:
        status, total, where = "status", "total", ""
        if kind == "update_postimage":
            status, total, where = "'shipped'", "CAST(ROUND(total * 1.05, 2) AS DECIMAL(18,2))", "WHERE id % 3 = 0"
        elif kind == "delete":
            where = "WHERE id % 17 = 0"
        ts = f"(order_date + INTERVAL {days} DAY)"
        parts.append(
            f"SELECT id, customer_id, {total} AS total, currency, order_date, {status} AS status, "
            f"'{kind}' AS _change_type, CAST((year({ts}) - {VERSION_EPOCH_YEAR}) * 12 + month({ts}) - 1 AS BIGINT) AS _commit_version, "
            f"{ts} AS _commit_ts, {seq} AS _seq FROM orders_r {where}")
    return "SELECT * FROM (WITH orders_r AS (" + SQL["orders"] + ") " + " UNION ALL ".join(parts) + ")"


SQL["order_changes"] = _order_changes_sql()


SQL["promotions"] = (
    "SELECT pr.id, pr.product_id, pr.badge_text, pr.discount_pct, "
    "CAST(ROUND(p.price * CAST(1 - pr.discount_pct / 100 AS DECIMAL(12,6)), 2) AS DECIMAL(10,2)) AS sale_price, "
    "pr.promo_type, pr.is_active, pr.start_date, pr.end_date "
    "FROM promotions_raw pr LEFT JOIN products p ON p.id = pr.product_id")

# CTEs an adapter's SQL refers to.
SQL_DEPS = {"promotions": ["products", "promotions_raw"]}


def with_sql(body: str, *names: str) -> str:
    """Prefix ``body`` with CTEs for the retail tables it uses (dependencies first)."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in SQL_DEPS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in ordered)
    return f"WITH {ctes} {body}" if ordered else body


# ---------------------------------------------------------------------------

class Tables:
    """Lazy retail view of one TD directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_td(self.spark, self.sf_dir, name)

    @cached_property
    def customers(self) -> DataFrame:
        return customers_from(self.raw("customer"))

    @cached_property
    def products(self) -> DataFrame:
        return products_from(self.raw("part"))

    @cached_property
    def orders(self) -> DataFrame:
        return orders_from(self.raw("orders"))

    @cached_property
    def order_items(self) -> DataFrame:
        return order_items_from(self.raw("lineitem"))

    @cached_property
    def order_items_ided(self) -> DataFrame:
        return order_items_from(self.raw("lineitem"), with_id=True)

    @cached_property
    def inventory(self) -> DataFrame:
        return inventory_from(self.raw("part"))

    @cached_property
    def reviews(self) -> DataFrame:
        return reviews_from(self.raw("lineitem"), self.raw("orders"))

    @cached_property
    def promotions_raw(self) -> DataFrame:
        return promotions_raw_from(self.raw("part"))

    @cached_property
    def promotions(self) -> DataFrame:
        from emporia.operators.promos import promo_sale_price
        return promo_sale_price(self.promotions_raw, self.products)

    @cached_property
    def exchange_rates(self) -> DataFrame:
        return exchange_rates(self.spark)

    @cached_property
    def cart_events(self) -> DataFrame:
        return cart_events_from(self.raw("events"), self.raw("part"))

    @cached_property
    def order_changes(self) -> DataFrame:
        return order_changes_from(self.raw("orders"))

    @cached_property
    def customer_leads(self) -> DataFrame:
        return customer_leads_from(self.raw("customer"), self.raw("nation"))

    @cached_property
    def query_log(self) -> DataFrame:
        return query_log_from(self.raw("events"))

    def as_dict(self, *names: str) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in names}
