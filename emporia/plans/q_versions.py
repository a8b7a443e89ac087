"""Registered version / restore / drift queries (G2-G9) and sync queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from emporia.operators import digests as D
from emporia.operators import loyalty as L
from emporia.operators import orders as O
from emporia.operators import sync as Y
from emporia.functions.ids import dense_ids
from emporia.operators import versions as V
from emporia.plans.registry import register
from emporia.session import scratch_path
from emporia.sources import catalog_tables as C
from emporia.sources.history import History
from emporia.sources.tables import with_sql

KEYS = ["id"]
ORDER_COLS = "id, customer_id, total, currency, order_date, status"
RESTORE_AT = "1998-06-30 12:00:00"
V0, V1 = 60, 72


def _latest_sql(where: str) -> str:
    return (f"(SELECT {ORDER_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY id "
            f"ORDER BY _commit_version DESC, _seq DESC) AS _rn FROM order_changes WHERE {where}) "
            f"WHERE _rn = 1 AND _change_type <> 'delete')")


AT_SQL = _latest_sql(f"_commit_ts <= TIMESTAMP '{RESTORE_AT}'")
V0_SQL = _latest_sql(f"_commit_version <= {V0}")
V1_SQL = _latest_sql(f"_commit_version <= {V1}")
ALL_SQL = _latest_sql("TRUE")


def _changes(t):
    return t.order_changes


def _history(t) -> History:
    """The orders' change feed as a partitioned log in the shared folder."""
    h = History(t.spark, scratch_path(t.spark, "emporia-history"), KEYS)
    h.append(_changes(t))
    return h


def _stored(df):
    """A table of its own, as the versions of a table are."""
    path = scratch_path(df.sparkSession, "emporia-version")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@register("as_of", with_sql(f"SELECT * FROM {AT_SQL}", "order_changes"))
def q_as_of(t):
    """G2 orders as they were at a given second."""
    return V.as_of(_changes(t), KEYS, RESTORE_AT)


@register("state_at_version", with_sql(f"SELECT * FROM {V0_SQL}", "order_changes"))
def q_state_at_version(t):
    """G2 orders after every change up to a version."""
    return V.state_at_version(_changes(t), KEYS, V0)


@register("restore_missing", with_sql(f"""
    SELECT * FROM {ALL_SQL} UNION ALL
    SELECT * FROM {AT_SQL} r WHERE r.id NOT IN (SELECT id FROM {ALL_SQL})""", "order_changes"))
def q_restore_missing(t):
    """G3 rows deleted since the restore point copied back; live rows kept."""
    live = V.state_at_version(_changes(t), KEYS, 10 ** 6)
    return V.restore_missing(live, V.as_of(_changes(t), KEYS, RESTORE_AT), KEYS)


@register("row_diff", with_sql(f"""
    SELECT COALESCE(o.id, n.id) AS id,
           CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM {V0_SQL} o FULL OUTER JOIN {V1_SQL} n ON o.id = n.id
    WHERE o.id IS NULL OR n.id IS NULL OR (o.customer_id, o.total, o.currency, o.order_date, o.status)
          IS DISTINCT FROM (n.customer_id, n.total, n.currency, n.order_date, n.status)""", "order_changes"))
def q_row_diff(t):
    """G4 keys added / removed / changed between two versions."""
    return V.row_diff(V.state_at_version(_changes(t), KEYS, V0), V.state_at_version(_changes(t), KEYS, V1), KEYS)


def _migrate_customers(tables):
    c = tables["customers"]
    if "loyalty_points" not in c.columns:
        c = L.backfill_points({"customers": c, "orders": tables["orders"]})
    if "email_verified" not in c.columns:
        c = O.email_verified(c)
    return dict(tables, customers=c)


def _migrate_orders(tables):
    o = tables["orders"]
    if "priority" not in o.columns:
        o = O.order_priority(o, 300000, 150000)
    return dict(tables, orders=o)


STEPS = [_migrate_customers, _migrate_orders]

_MIGRATED_SQL = ("(SELECT c.*, pts.loyalty_points, (c.id % 3 = 0) AS email_verified FROM customers c JOIN "
                 "(SELECT c.id, CAST(COALESCE(SUM(CAST(FLOOR(o.total) AS INTEGER)), 0) AS BIGINT) AS loyalty_points "
                 "FROM customers c LEFT JOIN orders o ON o.customer_id = c.id GROUP BY c.id) pts ON pts.id = c.id)")


@register("replay_migrations", with_sql(f"SELECT * FROM {_MIGRATED_SQL}", "customers", "orders"))
def q_replay_migrations(t):
    """G6 migrations replayed twice equal once (customers after replay)."""
    base = {"customers": t.customers, "orders": t.orders}
    once = V.replay_migrations(base, STEPS)
    return V.replay_migrations(once, STEPS)["customers"]


@register("reset_to_parent", with_sql(f"SELECT * FROM {_MIGRATED_SQL}", "customers", "orders"))
def q_reset_to_parent(t):
    """G7 a child that was migrated and lost rows, reset to the parent's latest state, its migrations replayed."""
    parent = {"customers": t.customers, "orders": t.orders}
    child = V.replay_migrations({"customers": t.customers.filter("id % 2 = 0"), "orders": t.orders}, STEPS)
    return V.reset_to_parent(child, parent, STEPS)["customers"]


# Distinct points can be more than a sketch counts exactly, so the key that SQL checks counts them exactly.
@register("schema_diff", with_sql(f"""
    SELECT 'loyalty_points' AS column_name, CAST(NULL AS VARCHAR) AS a_type, 'bigint' AS b_type, 'only_in_b' AS change,
           COUNT(*) FILTER (WHERE loyalty_points IS NULL) AS null_count, COUNT(DISTINCT loyalty_points) AS distinct_count
    FROM {_MIGRATED_SQL}
    UNION ALL
    SELECT 'email_verified', CAST(NULL AS VARCHAR), 'boolean', 'only_in_b',
           COUNT(*) FILTER (WHERE email_verified IS NULL), COUNT(DISTINCT email_verified) FROM {_MIGRATED_SQL}""",
                                  "customers", "orders"))
def q_schema_diff(t):
    """G5 drift between production customers and the migrated branch, with an exact profile."""
    migrated = V.replay_migrations({"customers": t.customers, "orders": t.orders}, STEPS)["customers"]
    return V.schema_diff(t.customers, migrated, profile=True, exact=True)


# The oracle counts exactly; a sketch's distinct count is shown as whether it lies within 5 % (three standard errors) of that.
@register("column_profile", with_sql("""
    SELECT c.column_name, CAST(0 AS BIGINT) AS null_count, true AS within_error, c.n AS exact_count FROM (
      SELECT 'id' AS column_name, COUNT(DISTINCT id) AS n FROM orders UNION ALL
      SELECT 'customer_id', COUNT(DISTINCT customer_id) FROM orders UNION ALL
      SELECT 'total', COUNT(DISTINCT total) FROM orders UNION ALL
      SELECT 'currency', COUNT(DISTINCT currency) FROM orders UNION ALL
      SELECT 'status', COUNT(DISTINCT status) FROM orders) c""", "orders"))
def q_column_profile(t):
    """G5 profile of five columns by one pass of sketches, held against exact counts."""
    cols = ["id", "customer_id", "total", "currency", "status"]
    near = V.column_profile(t.orders, cols)
    exact = V.column_profile(t.orders, cols, exact=True).select("column_name", F.col("distinct_count").alias("exact_count"))
    off = F.abs(F.col("distinct_count") - F.col("exact_count")) <= F.col("exact_count") * 0.05
    return near.join(exact, "column_name").select("column_name", "null_count", off.alias("within_error"), "exact_count")


@register("recovery_check", with_sql(f"""
    SELECT COUNT(*) AS before_rows, CAST(COALESCE(SUM(total), 0) AS DECIMAL(38,2)) AS before_revenue,
           COUNT(*) AS after_rows, CAST(COALESCE(SUM(total), 0) AS DECIMAL(38,2)) AS after_revenue, true AS match
    FROM {AT_SQL}""", "order_changes"))
def q_recovery_check(t):
    """G8 counts and revenue equal before the loss and after restoring the lost rows."""
    before = V.as_of(_changes(t), KEYS, RESTORE_AT)
    damaged = before.filter(F.col("status") != "pending")
    after = V.restore_missing(damaged, before, KEYS)
    return V.recovery_check(before, after)


EXPIRE_NOW = "2001-06-01 00:00:00"


# A full state after each month of changes since V1, every twelfth made by hand.
@register("expire_snapshots", with_sql(f"""
    SELECT kind, label, state_at FROM (
      SELECT 'v' || _commit_version AS label, CASE WHEN _commit_version % 12 = 0 THEN 'manual' ELSE 'scheduled' END AS kind,
             date_trunc('second', max(_commit_ts)) AS state_at FROM order_changes WHERE _commit_version >= {V1} GROUP BY _commit_version)
    WHERE kind = 'manual' OR state_at >= TIMESTAMP '{EXPIRE_NOW}' - INTERVAL 30 DAY""", "order_changes"))
def q_expire_snapshots(t):
    """G9 states that stay after expiry (30 days for scheduled ones); the others' folders are deleted."""
    h = _history(t)
    months = (_changes(t).filter(F.col("_commit_version") >= V1).groupBy("_commit_version")
              .agg(F.date_trunc("second", F.max("_commit_ts")).cast("timestamp_ntz").alias("at")).orderBy("_commit_version").collect())  # one row per month
    h.write_states([m["at"] for m in months], ["manual" if m._commit_version % 12 == 0 else "scheduled" for m in months],
                   [f"v{m._commit_version}" for m in months])
    return h.expire(EXPIRE_NOW, 30)


@register("as_of_history", with_sql(f"SELECT * FROM {AT_SQL}", "order_changes"))
def q_as_of_history(t):
    """G2 from the newest yearly state and the months of the log behind it."""
    h = _history(t)
    h.write_states([dt.datetime(y, 1, 1) for y in range(1996, 2002)])
    return h.as_of(RESTORE_AT).select(*ORDER_COLS.split(", "))


@register("row_diff_ranges", with_sql(f"""
    SELECT COALESCE(o.id, n.id) AS id,
           CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM {V0_SQL} o FULL OUTER JOIN {V1_SQL} n ON o.id = n.id
    WHERE o.id IS NULL OR n.id IS NULL OR (o.customer_id, o.total, o.currency, o.order_date, o.status)
          IS DISTINCT FROM (n.customer_id, n.total, n.currency, n.order_date, n.status)""", "order_changes"))
def q_row_diff_ranges(t):
    """G4 by digests of key ranges: only ranges that differ are joined."""
    old, new = [_stored(V.state_at_version(_changes(t), KEYS, v)) for v in (V0, V1)]
    return D.row_diff_by_ranges(old, new, KEYS)


@register("sync_verify_ranges", with_sql(f"""
    SELECT COUNT(s.id) AS source_rows, COUNT(t.id) AS target_rows,
           COUNT(*) FILTER (WHERE t.id IS NULL) AS missing_in_target,
           COUNT(*) FILTER (WHERE s.id IS NULL) AS extra_in_target,
           COUNT(*) FILTER (WHERE s.id = t.id AND (s.customer_id, s.total, s.currency, s.order_date, s.status)
             IS DISTINCT FROM (t.customer_id, t.total, t.currency, t.order_date, t.status)) AS stale_in_target
    FROM {ALL_SQL} s FULL OUTER JOIN {V1_SQL} t ON s.id = t.id""", "order_changes"))
def q_sync_verify_ranges(t):
    """A17 by digests of key ranges: source against a target synced only up to V1."""
    return D.sync_verify_by_ranges(_stored(V.state_at_version(_changes(t), KEYS, 10 ** 6)),
                                   _stored(V.state_at_version(_changes(t), KEYS, V1)), KEYS)


# The child: customers with even ids, and every tenth of those renamed; the reset gives the migrated parent.
@register("reset_drift", with_sql("""
    SELECT CAST(0 AS BIGINT) AS only_in_child, COUNT(*) FILTER (WHERE id % 2 <> 0) AS lost_by_child,
           COUNT(*) FILTER (WHERE id % 20 = 0) AS changed_by_child FROM customers""", "customers"))
def q_reset_drift(t):
    """G7 what a child had lost and changed before it was reset to its parent."""
    parent = {"customers": t.customers, "orders": t.orders}
    own = t.customers.filter("id % 2 = 0").withColumn("name", F.when(F.col("id") % 20 == 0, F.lit("renamed")).otherwise(F.col("name")))
    child = V.replay_migrations({"customers": own, "orders": t.orders}, STEPS)
    reset = V.reset_to_parent(child, parent, STEPS)
    return D.drift(_stored(child["customers"]), _stored(reset["customers"]), ["id"])


@register("merge_bucketed", with_sql(f"SELECT * FROM {ALL_SQL}", "order_changes"))
def q_merge_bucketed(t):
    """A9 + E8 a catalog table bucketed by key, synced to V0, then merged with every later change without an exchange of its rows."""
    name = f"orders_{uuid.uuid4().hex[:12]}"
    C.create_table(t.spark, name, t.orders.schema, KEYS, comment="serving copy of the orders", properties={"synced.version": str(V0)})
    C.load(V.state_at_version(_changes(t), KEYS, V0), name)
    C.merge(t.spark, name, _changes(t), since_version=V0)
    return t.spark.table(name).select(*ORDER_COLS.split(", "))


@register("next_ids", with_sql(f"""
    SELECT CAST((SELECT MAX(id) FROM {AT_SQL}) + row_number() OVER (ORDER BY id) AS BIGINT) AS id, id AS customer_id
    FROM customers WHERE segment = 'BUILDING'""", "order_changes", "customers"))
def q_next_ids(t):
    """E7 after a restore: new orders continue after the restored table's largest id."""
    before = V.as_of(_changes(t), KEYS, RESTORE_AT)
    restored = V.restore_missing(before.filter(F.col("status") != "pending"), before, KEYS)
    new = t.customers.filter(F.col("segment") == "BUILDING").select(F.col("id").alias("customer_id"))
    start = restored.select((F.max("id") + 1).alias("s"))
    return dense_ids(new, ["customer_id"], "id", start).select("id", "customer_id")


# --- sync (A) -----------------------------------------------------------------

@register("sync_triggered", with_sql(f"SELECT * FROM {ALL_SQL}", "order_changes"))
def q_sync_triggered(t):
    """A9 target synced to V0, then every later change applied."""
    target = V.state_at_version(_changes(t), KEYS, V0)
    return Y.sync_triggered(target, _changes(t), KEYS, since_version=V0)


@register("upsert", with_sql(f"SELECT * FROM {V1_SQL}", "order_changes"))
def q_upsert(t):
    """E8 merge of versions (V0, V1] into the V0 state, applied twice (idempotent)."""
    c = _changes(t).filter((F.col("_commit_version") > V0) & (F.col("_commit_version") <= V1))
    once = Y.upsert(V.state_at_version(_changes(t), KEYS, V0), c, KEYS)
    return Y.upsert(once, c, KEYS)


@register("choose_sync_mode", with_sql(f"""
    SELECT changed_rows, target_rows, changed_rows / target_rows AS changed_fraction,
           CASE WHEN changed_rows / target_rows > 0.10 THEN 'snapshot' ELSE 'triggered' END AS mode
    FROM (SELECT (SELECT COUNT(DISTINCT id) FROM order_changes WHERE _commit_version > {V1}) AS changed_rows,
                 (SELECT COUNT(*) FROM {V1_SQL}) AS target_rows)""", "order_changes"))
def q_choose_sync_mode(t):
    """A11 snapshot vs triggered from the changed-row fraction since the last sync; one pass over the feed's keys."""
    return Y.choose_sync_mode(Y.changed_ratio_of_feed(_changes(t), KEYS, V1))


_INSERTS_SQL = f"(SELECT {ORDER_COLS} FROM order_changes WHERE _change_type = 'insert')"


@register("insert_if_absent", with_sql(f"""
    SELECT * FROM {V0_SQL} UNION ALL
    SELECT * FROM {_INSERTS_SQL} i WHERE i.id NOT IN (SELECT id FROM {V0_SQL})""", "order_changes"))
def q_insert_if_absent(t):
    """A12 INSERT ... ON CONFLICT (id) DO NOTHING of every inserted order into the V0 state."""
    ins = _changes(t).filter(F.col("_change_type") == "insert").select(*ORDER_COLS.split(", "))
    return Y.insert_if_absent(V.state_at_version(_changes(t), KEYS, V0), ins, KEYS)


@register("insert_select", with_sql(f"""
    SELECT * FROM {V0_SQL} UNION ALL
    SELECT {ORDER_COLS} FROM order_changes WHERE _change_type = 'insert' AND _commit_version > {V0}""",
                                    "order_changes"))
def q_insert_select(t):
    """A13 INSERT INTO target SELECT ... (orders inserted after V0)."""
    ins = _changes(t).filter((F.col("_change_type") == "insert") & (F.col("_commit_version") > V0))
    return Y.insert_select(V.state_at_version(_changes(t), KEYS, V0), ins)


@register("sync_verify", with_sql(f"""
    SELECT COUNT(s.id) AS source_rows, COUNT(t.id) AS target_rows,
           COUNT(*) FILTER (WHERE t.id IS NULL) AS missing_in_target,
           COUNT(*) FILTER (WHERE s.id IS NULL) AS extra_in_target,
           COUNT(*) FILTER (WHERE s.id = t.id AND (s.customer_id, s.total, s.currency, s.order_date, s.status)
             IS DISTINCT FROM (t.customer_id, t.total, t.currency, t.order_date, t.status)) AS stale_in_target
    FROM {ALL_SQL} s FULL OUTER JOIN {V1_SQL} t ON s.id = t.id""", "order_changes"))
def q_sync_verify(t):
    """A17 source vs a target synced only up to V1: counts, missing keys and stale values."""
    return Y.sync_verify(V.state_at_version(_changes(t), KEYS, 10 ** 6),
                         V.state_at_version(_changes(t), KEYS, V1), KEYS)


@register("sync_listing", with_sql("""
    SELECT id, product_id, badge_text, discount_pct FROM promotions WHERE is_active ORDER BY discount_pct DESC, id""", "promotions"))
def q_sync_listing(t):
    """A17 active rows of the serving copy, largest discount first."""
    return Y.sync_listing(t.promotions).select("id", "product_id", "badge_text", "discount_pct")


@register("keyed_ctas", with_sql("""
    SELECT sha1(CAST(order_date AS VARCHAR) || CAST(total AS VARCHAR) || CAST(customer_id AS VARCHAR)) AS row_key, *
    FROM orders""", "orders"))
def q_keyed_ctas(t):
    """A3 content-hash key sha1(concat(cast(...))) prepended to the rows."""
    return Y.keyed_ctas(t.orders, ["order_date", "total", "customer_id"], "row_key")


@register("strip_null_bytes", "SELECT doc_id, replace(text, chr(0), '') AS text, lang, source FROM documents")
def q_strip_null_bytes(t):
    """A15 0x00 removed from document text (whole texts)."""
    return Y.strip_null_bytes(t.raw("documents").select("doc_id", "text", "lang", "source"), ["text"])


@register("string_to_binary", """
    SELECT doc_id, strlen(text) AS n_bytes, hex(encode(text)) AS bytes FROM documents""")
def q_string_to_binary(t):
    """A16 document text kept as exact bytes (shown in hex)."""
    b = Y.string_to_binary(t.raw("documents").select("doc_id", "text"), ["text"])
    return b.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.hex("text").alias("bytes"))


@register("map_types_for_sync", with_sql("""
    SELECT id, total, order_date, to_json({'currency': currency, 'status': status}) AS info,
           to_json([customer_id, id]) AS refs, to_json(MAP([currency], [status])) AS tags FROM orders""", "orders"))
def q_map_types_for_sync(t):
    """A14 nested columns turned into JSON text for the serving copy."""
    o = t.orders.select("id", "total", "order_date",
                        F.struct("currency", "status").alias("info"),
                        F.array("customer_id", "id").alias("refs"),
                        F.create_map(F.col("currency"), F.col("status")).alias("tags"))
    return Y.map_types_for_sync(o)[0]
