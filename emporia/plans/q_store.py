"""Registered keys for leads, stock, serving reads and the write-side
operators (A4-A8, A10, A18, B11, B12, B14, D15, G1).

The write-side keys write into a fresh folder under ``spark.checkpoint.dir``
(the shared folder of the cluster) and return the table read back, so their
result can be compared with SQL like any other key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from emporia.operators import catalog as C
from emporia.operators import loyalty as L
from emporia.operators import sync as Y
from emporia.operators import versions as V
from emporia.plans.q_versions import ALL_SQL, AT_SQL, KEYS, ORDER_COLS, RESTORE_AT, V0, V0_SQL
from emporia.plans.registry import register
from emporia.session import scratch_path
from emporia.sources import catalog_tables as CT
from emporia.sources.history import History
from emporia.sources.serving import read_serving_prices
from emporia.sources.store import TableStore, sync_continuous, sync_snapshot, sync_triggered
from emporia.sources.tables import with_sql


def _store(t) -> TableStore:
    return TableStore(t.spark, scratch_path(t.spark, "emporia-store"))


@register("leads_high_quality", with_sql("""
    SELECT company, industry, notes FROM customer_leads WHERE lead_quality = 'High'""", "customer_leads"))
def q_leads_high_quality(t):
    """B11 projection + equality filter on the leads table."""
    return C.leads_high_quality(t.customer_leads)


@register("distinct_industries", with_sql("SELECT DISTINCT industry FROM customer_leads ORDER BY industry",
                                          "customer_leads"))
def q_distinct_industries(t):
    """B12 SELECT DISTINCT industry."""
    return C.distinct_values(t.customer_leads, "industry")


@register("top_n_by_points", with_sql("""
    SELECT * FROM (SELECT c.*, pts.loyalty_points FROM customers c JOIN
      (SELECT c.id, CAST(COALESCE(SUM(CAST(FLOOR(o.total) AS INTEGER)), 0) AS BIGINT) AS loyalty_points
       FROM customers c LEFT JOIN orders o ON o.customer_id = c.id GROUP BY c.id) pts ON pts.id = c.id)
    ORDER BY loyalty_points DESC, id LIMIT 10""", "customers", "orders"))
def q_top_n_by_points(t):
    """B14 top 10 customers by loyalty points."""
    return C.top_n_by(L.backfill_points(t), "loyalty_points", 10)


@register("stock_by_product", with_sql("""
    SELECT product_id, SUM(quantity) AS quantity, SUM(reserved) AS reserved, COUNT(*) AS warehouses,
           SUM(quantity) - SUM(reserved) AS available FROM inventory GROUP BY product_id""", "inventory"))
def q_stock_by_product(t):
    """D15 stock over warehouses, available = quantity - reserved."""
    return C.stock_by_product(t)


@register("read_serving_prices", """
    SELECT p_partkey AS id, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part""")
def q_read_serving_prices(t):
    """A7 (id, price) from a serving copy, kept distributed and DECIMAL."""
    return read_serving_prices(t.spark, f"{t.sf_dir.rstrip('/')}/part.parquet", id_col="p_partkey",
                               price_col="p_retailprice")


@register("create_table_schema", with_sql("SELECT * FROM promotions", "promotions"))
def q_create_table_schema(t):
    """A4 typed empty catalog table with comment and properties, then seeded and read back."""
    name = f"promotions_{uuid.uuid4().hex[:12]}"
    CT.create_table(t.spark, name, t.promotions.schema, ["id"], comment="Spring Sale promotions", properties={"change_feed": "true"})
    created = t.spark.table(name).schema
    if [(f.name, f.dataType) for f in created] != [(f.name, f.dataType) for f in t.promotions.schema]:
        raise AssertionError("created table does not have the declared schema")
    CT.load(t.promotions, name)
    return t.spark.table(name)


@register("overwrite_table", with_sql("SELECT * FROM promotions", "promotions"))
def q_overwrite_table(t):
    """A5 seed without sale prices, then overwrite with computed sale prices."""
    st = _store(t)
    st.overwrite(t.promotions_raw, "promotions")
    st.overwrite(t.promotions, "promotions")
    return st.read("promotions")


@register("append_table", with_sql("SELECT * FROM promotions", "promotions"))
def q_append_table(t):
    """A6 active promotions first, the rest appended."""
    st = _store(t)
    st.overwrite(t.promotions.filter(F.col("is_active")), "promotions")
    st.append(t.promotions.filter(~F.col("is_active")), "promotions")
    return st.read("promotions")


@register("sync_snapshot", with_sql(f"SELECT * FROM {ALL_SQL}", "order_changes"))
def q_sync_snapshot(t):
    """A8 full replace of the serving copy with the current source state."""
    st = _store(t)
    sync_snapshot(st, V.state_at_version(t.order_changes, KEYS, 10 ** 6), "orders", keys=KEYS)
    return st.read("orders")


@register("sync_triggered_store", with_sql(f"SELECT * FROM {ALL_SQL}", "order_changes"))
def q_sync_triggered_store(t):
    """A9 on a stored copy: snapshot at V0, then only the newer changes are appended and merged on read."""
    st = _store(t)
    sync_snapshot(st, V.state_at_version(t.order_changes, KEYS, V0), "orders", keys=KEYS, source_version=V0)
    sync_triggered(st, t.order_changes, "orders")
    return st.read("orders")


@register("sync_continuous", with_sql(f"SELECT * FROM {ALL_SQL}", "order_changes"))
def q_sync_continuous(t):
    """A10 change files streamed into the serving copy (micro-batches, restart-safe)."""
    st = _store(t)
    feed = f"{st.root}/_feed"
    t.order_changes.repartition(4, "_commit_version").write.parquet(feed)
    empty = t.spark.createDataFrame([], t.orders.schema)
    sync_snapshot(st, empty, "orders", keys=KEYS, source_version=-1)
    stream = t.spark.readStream.schema(t.order_changes.schema).option("maxFilesPerTrigger", 2).parquet(feed)
    sync_continuous(stream, st, "orders", f"{st.root}/_checkpoint").awaitTermination()
    return st.read("orders")


@register("snapshot_table", with_sql(f"SELECT * FROM {AT_SQL}", "order_changes"))
def q_snapshot_table(t):
    """G1 a named full state as of a time keeps its contents while changes go on."""
    h = History(t.spark, scratch_path(t.spark, "emporia-history"), KEYS)
    until = F.col("_commit_ts") <= F.lit(RESTORE_AT).cast("timestamp_ntz")
    h.append(t.order_changes.filter(until))
    h.snapshot("before-sync", RESTORE_AT)
    h.append(t.order_changes.filter(~until))
    return h.state(RESTORE_AT).select(*ORDER_COLS.split(", "))


@register("additive_schema_sync", with_sql(f"""
    SELECT *, CAST(NULL AS VARCHAR) AS priority FROM {V0_SQL}
    UNION ALL SELECT {ORDER_COLS}, CASE WHEN total > 300000 THEN 'high' ELSE 'normal' END AS priority
    FROM order_changes WHERE _change_type = 'insert' AND _commit_version > {V0}""", "order_changes"))
def q_additive_schema_sync(t):
    """A18 incremental rows that add a column are accepted (NULL for old rows)."""
    from emporia.operators.orders import order_priority
    target = V.state_at_version(t.order_changes, KEYS, V0)
    new = t.order_changes.filter((F.col("_change_type") == "insert") & (F.col("_commit_version") > V0)) \
        .select(*ORDER_COLS.split(", "))
    new = order_priority(new, 300000, 300000)
    return Y.additive_schema_sync(target, new)
