"""Registered query-log / activity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from emporia.functions import scalars as S
from emporia.operators import activity as A
from emporia.plans.registry import register
from emporia.sources.tables import with_sql

_NORM = A.normalise_query_sql("query")


@register("normalise_query", with_sql(f"SELECT *, {_NORM} AS normalized_query FROM query_log", "query_log"))
def q_normalise_query(t):
    """I2 literals replaced by $n placeholders."""
    return A.normalise_query(t.query_log)


@register("slowest_queries", with_sql(f"""
    SELECT normalized_query, COUNT(*) AS calls, CAST(SUM(_ms) AS DECIMAL(38,2)) AS total_exec_time,
           {S.avg_round_sql('_ms', 3, 2)} AS mean_exec_time,
           CAST({S.half_up_div_sql('SUM(_ms) * 100', 'COUNT(*) * 100', 3)} AS DECIMAL(18,3)) AS avg_time_ms
    FROM (SELECT {_NORM} AS normalized_query, CAST(duration_ms AS DECIMAL(18,2)) AS _ms FROM query_log)
    GROUP BY normalized_query ORDER BY mean_exec_time DESC, normalized_query LIMIT 20""", "query_log"))
def q_slowest_queries(t):
    """I1 top 20 normalised queries by mean time."""
    return A.slowest_queries(t.query_log, 20)


@register("row_activity", with_sql("""
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
           COUNT(*) FILTER (WHERE operation = 'insert') AS inserts, COUNT(*) FILTER (WHERE operation = 'update') AS updates,
           COUNT(*) FILTER (WHERE operation = 'delete') AS deletes
    FROM query_log GROUP BY 1, 2""", "query_log"))
def q_row_activity(t):
    """I3 inserts / updates / deletes per 5-minute window."""
    return A.row_activity(t.query_log, "5 minutes")


_WIDTHS = [("5 minutes", 1), ("15 minutes", 3), ("1 hour", 12)]


_WORKING_SET_SQL = with_sql(" UNION ALL ".join(f"""
    SELECT '{w}' AS width, s AS window_start, s + INTERVAL {k * 5} MINUTE AS window_end, COUNT(DISTINCT user_id) AS items
    FROM (SELECT user_id, time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(CAST(5 * r.i AS BIGINT)) AS s
          FROM query_log, range(0, {k}) r(i)) GROUP BY s""" for w, k in _WIDTHS), "query_log")


@register("working_set", _WORKING_SET_SQL)
def q_working_set(t):
    """I4 distinct users touched in the last 5 min / 15 min / 1 h, every 5 min."""
    return A.working_set(t.query_log, [w for w, _ in _WIDTHS], "5 minutes")


# The given tables have fewer users in any hour than a sketch of this size counts exactly, so the exact SQL holds.
@register("working_set_sketch", _WORKING_SET_SQL)
def q_working_set_sketch(t):
    """I4 from one sketch for each pane, merged to the windows."""
    return A.working_set_sketch(A.pane_sketches(t.query_log), [w for w, _ in _WIDTHS])


@register("cache_hit_rate", with_sql(f"""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
           COUNT(*) AS reads, COUNT(*) FILTER (WHERE cache_hit) AS hits,
           CAST({S.half_up_div_sql("COUNT(*) FILTER (WHERE cache_hit)", "COUNT(*)", 4)} AS DECIMAL(10,4)) AS hit_rate,
           CAST({S.half_up_div_sql("COUNT(*) FILTER (WHERE cache_hit)", "COUNT(*)", 4)} AS DECIMAL(10,4)) < 0.99 AS below_target
    FROM query_log WHERE cache_hit IS NOT NULL GROUP BY 1, 2""", "query_log"))
def q_cache_hit_rate(t):
    """I5 hourly cache hit rate vs the 99% target."""
    return A.cache_hit_rate(t.query_log, "1 hour", 0.99)


@register("failed_operations", with_sql("""
    SELECT query_id, ts, operation, query, duration_ms FROM query_log WHERE status = 'Error'
    ORDER BY duration_ms DESC, query_id""", "query_log"))
def q_failed_operations(t):
    """I6 failed operations, slowest first."""
    return A.failed_operations(t.query_log)


@register("connection_usage", with_sql(f"""
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
           COUNT(DISTINCT CASE WHEN operation IN ('insert', 'update', 'delete') THEN user_id END) AS active,
           COUNT(DISTINCT user_id) - COUNT(DISTINCT CASE WHEN operation IN ('insert', 'update', 'delete') THEN user_id END) AS idle,
           COUNT(DISTINCT user_id) AS total, 100 AS max_connections,
           CAST({S.half_up_div_sql('COUNT(DISTINCT user_id)', '100', 4)} AS DECIMAL(10,4)) AS utilization
    FROM query_log GROUP BY 1, 2""", "query_log"))
def q_connection_usage(t):
    """I7 active / idle / total sessions per hour vs 100 connections."""
    return A.connection_usage(t.query_log, "1 hour", 100)


@register("replication_lag", with_sql("""
    SELECT c.version, c.committed_at, a.applied_at, a.applied_rows,
           CAST((epoch_us(a.applied_at) - epoch_us(c.committed_at)) // 1000000 AS BIGINT) AS lag_seconds
    FROM (SELECT _commit_version AS version, MAX(_commit_ts) AS committed_at FROM order_changes GROUP BY 1) c
    JOIN (SELECT _commit_version AS version, MAX(_commit_ts + to_seconds(CAST(id % 60 AS BIGINT))) AS applied_at,
                 COUNT(*) AS applied_rows FROM order_changes GROUP BY 1) a ON a.version = c.version""",
                                      "order_changes"))
def q_replication_lag(t):
    """I8 commit-to-apply gap per version of the orders change feed."""
    ch = t.order_changes
    commits = ch.select(F.col("_commit_version").alias("version"), F.col("_commit_ts").alias("committed_at"))
    applies = ch.select(F.col("_commit_version").alias("version"),
                        (F.col("_commit_ts") + F.make_dt_interval(secs=F.pmod("id", F.lit(60)))).alias("applied_at"))
    return A.replication_lag(commits, applies)
