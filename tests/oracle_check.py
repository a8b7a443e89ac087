"""Compare registered Spark queries with their DuckDB oracle SQL.

Same check the driver makes: row count, column names, and an
order-insensitive hash of the values. Usable from pytest and as a script:

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TD_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
             "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TD_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return bool(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_hash(cols: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for k in keyed:
        h.update(k.encode())
    return h.hexdigest()


def compare(spark, con, key: str, sf_dir: str, run, sql: str) -> dict:
    t0 = time.time()
    sdf = run(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    from emporia.session import drop_scratch
    drop_scratch(spark)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "key": key,
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_sec": round(t1 - t0, 2),
    }
    out["hash_match"] = out["cols_match"] and rows_hash(s_cols, s_rows) == rows_hash(d_cols, d_rows)
    out["ok"] = out["hash_match"] and len(s_rows) == len(d_rows)
    if not out["ok"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        sa = sorted(repr(tuple(_norm(r[i]) for i in sorted(range(len(s_cols)), key=lambda i: s_cols[i]))) for r in s_rows)
        da = sorted(repr(tuple(_norm(r[i]) for i in sorted(range(len(d_cols)), key=lambda i: d_cols[i]))) for r in d_rows)
        out["only_spark"] = [x for x in sa if x not in set(da)][:3]
        out["only_oracle"] = [x for x in da if x not in set(sa)][:3]
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    if os.environ.get("VANILLA_SESSION"):
        # The driver's own session: defaults only (ANSI on in Spark 4, local time zone).
        from pyspark.sql import SparkSession
        b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
        if os.environ.get("SESSION_TZ"):
            b = b.config("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
        spark = b.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from emporia.session import get_spark
        spark = get_spark("local[8]")
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or list(qs)):
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            print(f"{k:32s} rows-only rows={df.count()}")
            continue
        try:
            r = compare(spark, con, k, sf_dir, qs[k], sqls[k])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{k:32s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        bad += not r["ok"]
        print(f"{k:32s} {'OK ' if r['ok'] else 'BAD'} rows={r['spark_rows']}/{r['oracle_rows']} "
              f"{r['spark_sec']}s" + ("" if r["ok"] else f" {r}"))
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
