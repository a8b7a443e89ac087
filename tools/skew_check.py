"""Hot-key check: does any single task read a large share of a shuffle?

Builds skewed inputs from the test data -- a third of all cart events moved
to one customer (who has many products), a third of all cart lines moved to
one product within one hour (from many customers), a third of the order
change feed moved to one key; broadcasts are off, so every join shuffles -- runs the operators that group by those keys, and reads Spark's
event log (written to a scratch folder) to find, per shuffle stage, the
largest share of shuffle records read by one task. Also checks that the
results are complete (row counts; the closed-form cart fold is checked
against a sequential fold on skewed random inputs in tests/test_edges.py).

    python tools/skew_check.py [sf_dir]   -> prints JSON, writes docs/SKEW.md
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _stage_shares(log_dir: str) -> dict[int, dict]:
    """stage id -> {tasks, records, max_share, name} from the event log."""
    # Spark 4 writes rolling event logs: a directory of event files per app.
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f) and "appstatus" not in os.path.basename(f))
    per_stage: dict[int, list[int]] = {}
    names: dict[int, str] = {}
    for path in files:
        if path.endswith(".zstd"):
            import io
            import zstandard
            fh = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
        else:
            fh = open(path, encoding="utf-8")
        with fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageSubmitted":
                    info = ev["Stage Info"]
                    names[info["Stage ID"]] = info.get("Stage Name", "")
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                rd = m.get("Shuffle Read Metrics") or {}
                recs = rd.get("Total Records Read", 0)
                if recs:
                    per_stage.setdefault(ev["Stage ID"], []).append(recs)
    out = {}
    for sid, recs in per_stage.items():
        tot = sum(recs)
        out[sid] = {"tasks": len(recs), "records": tot, "max_task_records": max(recs),
                    "max_share": round(max(recs) / tot, 3), "name": names.get(sid, "")}
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="run-skew-", dir="/tmp")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from emporia.session import DEFAULT_CONF, checkpoint_dir
    b = (SparkSession.builder.master("local[8]").appName("emporia-skew")
         .config("spark.sql.shuffle.partitions", "16")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
         .config("spark.eventLog.compress", "false")
         )
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    # Keep all 16 reduce partitions (no coalescing of the small test shuffles),
    # so the spread of records over tasks is visible.
    b = b.config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # Small sides would be broadcast here and hide the shuffles a large table has.
    b = b.config("spark.sql.autoBroadcastJoinThreshold", "-1").config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    # The adaptive skew join acts from 256 MB a partition by default; these partitions are as much smaller as the tables are.
    b = (b.config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16k")
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k").config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)

    from emporia.operators import cart as H
    from emporia.operators import versions as V
    from emporia.sources.tables import Tables

    t = Tables(spark, sf_dir)
    ev = t.cart_events
    hot = F.pmod(F.col("event_id"), F.lit(3)) == 0
    one_customer = ev.withColumn("customer_id", F.when(hot, F.lit(0)).otherwise(F.col("customer_id")))
    # One line for each event: many customers ask for product 0 within one hour.
    lines = (ev.filter(F.col("action") == "add").select(
        F.col("event_id").alias("customer_id"), F.when(hot, F.lit(0)).otherwise(F.col("product_id")).alias("product_id"),
        F.lit(1).cast("long").alias("quantity"),
        F.when(hot, F.date_trunc("hour", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
               + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod("event_id", F.lit(3600)).cast("decimal(18,6)")))
        .otherwise(F.col("ts")).alias("ts")))
    plenty = t.inventory.withColumn("quantity", F.when(F.col("product_id") == 0, F.lit(2000)).otherwise(F.col("quantity")))
    ch = t.order_changes
    skewed_ch = ch.withColumn("id", F.when(F.pmod(F.col("id"), F.lit(3)) == 0, F.lit(0)).otherwise(F.col("id")))

    jobs = {
        "cart_state": lambda: H.cart_state(one_customer, t.products),
        "allocate_stock": lambda: H.allocate_stock(lines, plenty),
        "as_of": lambda: V.state_at_version(skewed_ch, ["id"], 10 ** 6),
    }
    report = {"sf": sf_dir, "hot_share_of_input": 0.333, "jobs": {}}
    for name, build in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        rows = build().count()
        report["jobs"][name] = {"rows": rows, "sec": round(time.perf_counter() - t0, 2)}
    spark.stop()
    shares = _stage_shares(log_dir)
    report["stages"] = shares
    worst = max((s["max_share"] for s in shares.values() if s["tasks"] > 1 and s["records"] >= 1000), default=0.0)
    report["worst_task_share_of_a_shuffle"] = worst
    print(json.dumps({k: v for k, v in report.items() if k != "stages"}))
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "SKEW.md"), "w") as f:
        f.write("# Hot-key check\n\nGenerated by `tools/skew_check.py` on `%s`: a third of the cart events moved to "
                "one customer, a third of the cart lines to one product in one hour, a third of the order change feed to one key; "
                "no broadcasts; the adaptive skew join acts from 16 KB. Per shuffle stage, the "
                "largest share of the stage's shuffle records read by a single task (from the event log).\n\n" % sf_dir)
        f.write("| stage | tasks | records | max task records | max share |\n|---|---|---|---|---|\n")
        for sid, s in sorted(shares.items()):
            if s["tasks"] > 1:
                f.write(f"| {sid} | {s['tasks']} | {s['records']} | {s['max_task_records']} | {s['max_share']} |\n")
        f.write(f"\nWorst single-task share of any multi-task shuffle stage of 1,000 records or more: **{worst}** "
                "(a hot key collected into one task would show >= 0.33).\n\n")
        f.write("Jobs: " + json.dumps(report["jobs"]) + "\n")


if __name__ == "__main__":
    main(sys.argv)
