"""A table's history as two partitioned tables: its change log, and full states at some times (keys G1, G2, G9).

* ``log``: the change feed, partitioned by the month of the commit time and
  sorted by time inside;
* ``states``: the newest change of every key (deletes included) as of a time,
  partitioned by that time. ``marks`` names each state (kind and label), one
  small row a state, partitioned alike.

The table as of T is the newest state at or before T with the log's rows
between the two: older states and other months are not read. A change decides
by (version, seq), as everywhere, so one that arrives with an older version
than the state's row changes nothing.

A state holds what the log held when it was written: changes appended later with
a commit time before it are not in it, so states are written when their time is
closed (as a feed's commits arrive in order of time).

Scheduled states age out (``expire``); snapshots made by hand stay. All three
are ordinary Parquet folders that any reader can open.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.operators.sync import CHANGE_COLS, first_per_key, latest_changes
from emporia.operators.versions import RESTORE_WINDOW_DAYS, as_time
from emporia.session import path_exists

MARKS = "kind string, label string, state_at timestamp_ntz, at long"


def _month(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def _epoch(at: dt.datetime) -> int:
    return int(at.replace(tzinfo=dt.timezone.utc).timestamp())


class History:
    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    # --- writes -----------------------------------------------------------------
    def append(self, changes: DataFrame) -> None:
        """Change rows into the log, by month; a month with a third of the rows is several files."""
        (changes.withColumn("_month", _month(F.col("_commit_ts"))).repartitionByRange("_month", "_commit_ts")
         .sortWithinPartitions("_month", "_commit_ts")
         .write.mode("append").partitionBy("_month").parquet(f"{self.path}/log"))

    def write_states(self, times: list[dt.datetime], kinds: list[str] | None = None, labels: list[str | None] | None = None) -> None:
        """Full states at several times in one pass over the log.

        The newest change of a key in each stretch between two times is found
        first (a group limit below the shuffle), so a hot key has one row a
        stretch. Each such row stands from its own time until a later stretch
        has a newer version, and goes into the states in between.
        """
        order = sorted(range(len(times)), key=lambda i: times[i])
        times = [times[i] for i in order]
        kinds = [kinds[i] for i in order] if kinds else ["scheduled"] * len(times)
        labels = [labels[i] for i in order] if labels else [None] * len(times)
        log = self.log().filter((F.col("_change_type") != "update_preimage") & (F.col("_commit_ts") <= F.lit(times[-1])))
        stretch = sum([(F.col("_commit_ts") > F.lit(t)).cast("int") for t in times[:-1]], F.lit(0))
        newest = first_per_key(log.withColumn("_from", stretch), [*self.keys, "_from"],
                               [F.col("_commit_version").desc(), F.col("_seq").desc()])
        by_key = Window.partitionBy(*self.keys).orderBy("_from")
        mine = F.struct("_commit_version", "_seq")
        # Only rows newer by version than all of the key's earlier ones take over; each holds until the next such row.
        best = F.max(mine).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
        takes = newest.withColumn("_best", best).filter(F.col("_best").isNull() | (mine > F.col("_best"))).drop("_best")
        until = F.coalesce(F.lead("_from").over(by_key), F.lit(len(times)))
        at = F.array(*[F.lit(_epoch(t)) for t in times])
        held = (takes.withColumn("_until", until)
                .select(*[c for c in takes.columns if c != "_from"], F.explode(F.slice(at, F.col("_from") + 1, F.col("_until") - F.col("_from"))).alias("at")))
        (held.repartitionByRange("at", *self.keys).write.mode("append").partitionBy("at").parquet(f"{self.path}/states"))
        marks = self.spark.createDataFrame([(k, x, t, _epoch(t)) for k, x, t in zip(kinds, labels, times)], MARKS)
        marks.coalesce(1).write.mode("append").partitionBy("at").parquet(f"{self.path}/marks")

    def snapshot(self, label: str, at) -> None:
        """G1: a named full state as of a time; it stays until it is deleted by hand."""
        self.write_states([as_time(at)], ["manual"], [label])

    # --- reads ------------------------------------------------------------------
    def log(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/log").drop("_month")

    def marks(self) -> DataFrame:
        """(kind, label, state_at) of the states, one short row each."""
        if not path_exists(self.spark, f"{self.path}/marks"):
            return self.spark.createDataFrame([], MARKS)
        return self.spark.read.schema(MARKS).parquet(f"{self.path}/marks")

    def state(self, at) -> DataFrame:
        """The rows of the state written for exactly that time."""
        rows = self.spark.read.parquet(f"{self.path}/states").filter(F.col("at") == _epoch(as_time(at)))
        return rows.filter(F.col("_change_type") != "delete").drop(*CHANGE_COLS, "at")

    def as_of(self, ts, now=None, window_days: int = RESTORE_WINDOW_DAYS) -> DataFrame:
        """The table as it was at ``ts``; ``now`` bounds how far back that may be (see ``versions.as_of``)."""
        from emporia.operators.versions import require_in_window
        t = as_time(ts)
        if now is not None:
            require_in_window(ts, as_time(now) - dt.timedelta(days=window_days))
        base = self.marks().filter(F.col("at") <= _epoch(t)).agg(F.max("at")).first()[0]
        log = self.spark.read.parquet(f"{self.path}/log")
        if base is not None:
            since = dt.datetime.fromtimestamp(base, dt.timezone.utc).replace(tzinfo=None)
            log = log.filter((F.col("_month") >= since.year * 100 + since.month) & (F.col("_commit_ts") > F.lit(since)))
        log = log.filter(F.col("_month") <= t.year * 100 + t.month).drop("_month")
        tail = latest_changes(log, self.keys, until_ts=t, with_seq=True)
        if base is None:
            return tail.filter(F.col("_change_type") != "delete").drop("_change_type", "_commit_version", "_seq")
        rows = self.spark.read.parquet(f"{self.path}/states").filter(F.col("at") == base).drop("at", "_commit_ts")
        data = [c for c in rows.columns if c not in (*self.keys, *CHANGE_COLS)]

        def packed(df: DataFrame, name: str) -> DataFrame:
            return df.select(*self.keys, F.struct("_commit_version", "_seq", "_change_type", *data).alias(name))
        # The state is streamed past the tail, which is broadcast if it proves small; neither is a full outer join's side.
        tail, state = packed(tail, "_t"), packed(rows, "_s")
        newer = F.col("_t").isNotNull() & ((F.col("_t._commit_version") > F.col("_s._commit_version")) | (
            (F.col("_t._commit_version") == F.col("_s._commit_version")) & (F.col("_t._seq") > F.col("_s._seq"))))
        kept = state.join(tail, self.keys, "left").select(*self.keys, F.when(newer, F.col("_t")).otherwise(F.col("_s")).alias("_r"))
        known = state.select(*self.keys).join(tail.select(*self.keys), self.keys, "left_semi")
        added = tail.join(known, self.keys, "left_anti").select(*self.keys, F.col("_t").alias("_r"))
        return (kept.unionByName(added).filter(F.col("_r._change_type") != "delete")
                .select(*self.keys, *[F.col(f"_r.{c}").alias(c) for c in data]))

    # --- retention --------------------------------------------------------------
    def expire(self, now, retention_days: int = RESTORE_WINDOW_DAYS) -> DataFrame:
        """Delete scheduled states older than the retention; returns the marks of those that stay."""
        from emporia.operators.versions import stays
        marks = self.marks()
        gone = [r["at"] for r in marks.filter(~stays("kind", "state_at", now, retention_days)).select("at").distinct().collect()]
        held = {r["at"] for r in marks.filter(stays("kind", "state_at", now, retention_days)).select("at").distinct().collect()}
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for at in gone:  # one folder of states and one of marks each; rows are never read
            for part in ("states", "marks"):
                if at not in held:
                    p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}/at={at}")
                    p.getFileSystem(conf).delete(p, True)
        return self.marks().filter(stays("kind", "state_at", now, retention_days)).drop("at")
