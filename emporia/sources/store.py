"""Versioned tables in a shared folder (keys A4-A6, A8-A10, G1).

A table is a folder with one small pointer row per version (``_versions``)
and one Parquet folder per write. A pointer row names only what its own
version added; a version is read by following the rows back to the last full
replace:

* *rows* folders hold full rows (a replace, or an append). Each notes the
  source version it stands at;
* *changes* folders hold change-feed rows (``operators.sync``).

Reading applies the newest change of each key to the rows that are older than it
and adds the changed rows. A table without changes is a plain Parquet read.
Written folders are never touched again, and the pointer row is written last,
so readers of older versions are not disturbed and a failed write leaves the
previous version in place. There is one writer per table.

An incremental sync writes the changes only; ``sync_snapshot`` writes a full
copy (A11, ``operators.sync.choose_sync_mode``, chooses between them).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import sync as Y
from emporia.session import path_exists

POINTER = ("table_name string, version long, kind string, label string, created_at timestamp_ntz, rows long, path string, "
           "keys array<string>, source_version long, streams map<string,long>, schema_json string, properties string")
MAX_MANUAL_SNAPSHOTS = 10


class SnapshotLimitError(ValueError):
    pass


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- versions ---------------------------------------------------------------
    def versions(self, name: str) -> DataFrame:
        """The table's pointer rows, one per version (empty if there is no such table)."""
        path = f"{self.root}/{name}/_versions"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], POINTER)
        return self.spark.read.schema(POINTER).parquet(path)

    def history(self, name: str, version: int | None = None) -> list:
        """The pointer rows up to a version, oldest first; none if there is no such version.

        Metadata only: a short row per version of this table.
        """
        rows = sorted(self.versions(name).collect(), key=lambda r: r["version"])
        if version is None:
            return rows
        rows = [r for r in rows if r["version"] <= version]
        return rows if rows and rows[-1]["version"] == version else []

    def latest(self, name: str, version: int | None = None):
        """The newest pointer row, or that of a version; the driver gets this one row."""
        rows = self.versions(name)
        rows = rows if version is None else rows.filter(F.col("version") == version)
        found = rows.orderBy(F.col("version").desc()).limit(1).collect()
        return found[0] if found else None

    def latest_version(self, name: str) -> int | None:
        r = self.latest(name)
        return None if r is None else r["version"]

    def version_at(self, name: str, ts) -> int | None:
        """Newest version committed at or before ``ts`` (point in time)."""
        at = ts if isinstance(ts, dt.datetime) else dt.datetime.fromisoformat(str(ts))
        found = [r["version"] for r in self.history(name) if r["created_at"] <= at]
        return max(found) if found else None

    def _commit(self, name: str, kind: str, schema: T.StructType, prev, *, path=None, rows=None, keys=None, label=None, at=None,
                source_version=None, streams=None, properties=None) -> int:
        keep = lambda value, field: value if value is not None else (prev[field] if prev else None)
        row = (name, 0 if prev is None else prev["version"] + 1, kind, label,
               at or dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None), rows, path,
               list(keys) if keys else (prev["keys"] if prev else None), keep(source_version, "source_version"), keep(streams, "streams"),
               schema.json(), keep(json.dumps(properties) if properties else None, "properties"))
        (self.spark.createDataFrame([row], POINTER).coalesce(1)
         .write.mode("append").parquet(f"{self.root}/{name}/_versions"))
        return row[1]

    def _write(self, df: DataFrame, name: str) -> tuple[str, int, int | None]:
        """(path, rows, highest source version of change rows), counted while the rows are written."""
        path, seen = f"{self.root}/{name}/{uuid.uuid4().hex[:16]}", Observation()
        top = F.max("_commit_version") if "_commit_version" in df.columns else F.max(F.lit(None).cast("long"))
        df.observe(seen, F.count(F.lit(1)).alias("n"), top.alias("top")).write.mode("errorifexists").parquet(path)
        found = seen.get
        return path, found["n"], found["top"]

    # --- reads ------------------------------------------------------------------
    def read(self, name: str, version: int | None = None) -> DataFrame:
        rows = self.history(name, version)
        if not rows:
            raise KeyError(f"no table {name}" + (f" version {version}" if version is not None else ""))
        schema = T.StructType.fromJson(json.loads(rows[-1]["schema_json"]))
        start = max(i for i, r in enumerate(rows) if r["kind"] in ("create", "overwrite"))
        parts = [r for r in rows[start:] if r["path"]]
        changes = [r["path"] for r in parts if r["kind"] == "changes"]
        plain = [r for r in parts if r["kind"] != "changes"]
        if not changes:
            return self.spark.read.schema(schema).parquet(*[r["path"] for r in plain])
        keys = list(rows[-1]["keys"])
        feed_schema = T.StructType(schema.fields + Y.CHANGE_FIELDS)
        feed = self.spark.read.schema(feed_schema).parquet(*changes)
        if rows[start]["source_version"] is not None:  # the copy holds these already
            feed = feed.filter(F.col("_commit_version") > rows[start]["source_version"])
        newest = Y.latest_changes(feed, keys)
        out = newest.filter(F.col("_change_type") != "delete").select(*schema.names)
        # Rows of one source version are read together; a change touches those older than itself.
        by_version: dict = {}
        for r in plain:
            by_version.setdefault(r["source_version"], []).append(r["path"])
        for at, paths in by_version.items():
            newer = newest if at is None else newest.filter(F.col("_commit_version") > at)
            kept = self.spark.read.schema(schema).parquet(*paths).join(newer.select(*keys), keys, "left_anti")
            out = out.unionByName(kept)
        return out

    # --- writes -----------------------------------------------------------------
    def create(self, name: str, schema: T.StructType, comment: str | None = None, properties: dict | None = None,
               keys: list[str] | None = None) -> int:
        """A4: typed, empty table with a comment and properties."""
        props = dict(properties or {}) | ({"comment": comment} if comment else {})
        path, _, _ = self._write(self.spark.createDataFrame([], schema), name)
        return self._commit(name, "create", schema, self.latest(name), path=path, rows=0, keys=keys, properties=props)

    def overwrite(self, df: DataFrame, name: str, keys: list[str] | None = None, label: str | None = None,
                  source_version: int | None = None) -> int:
        """A5: full replace (the schema may change) as a new version."""
        path, n, _ = self._write(df, name)
        return self._commit(name, "overwrite", df.schema, self.latest(name), path=path, rows=n, keys=keys, label=label,
                            source_version=source_version)

    def append(self, df: DataFrame, name: str) -> int:
        """Append rows. They stand after all changes recorded so far and are
        replaced or deleted by later ones only."""
        prev = self.latest(name)
        if prev is None:
            return self.overwrite(df, name)
        schema = T.StructType.fromJson(json.loads(prev["schema_json"]))
        path, n, _ = self._write(df.select(*schema.names), name)
        return self._commit(name, "append", schema, prev, path=path, rows=n)

    def append_changes(self, changes: DataFrame, name: str, stream: str | None = None, batch_id: int | None = None,
                       prev=None) -> int | None:
        """Record change rows; readers apply them. One pass over ``changes``; no rows, no version (None).

        Columns may be added (A18); dropped or retyped ones raise. ``prev`` is the latest pointer row, if known.
        """
        prev = prev or self.latest(name)
        if prev is None:
            raise KeyError(f"no table {name}")
        streams = None if stream is None else dict(prev["streams"] or {}) | {stream: batch_id}
        if not prev["keys"]:
            raise ValueError(f"table {name} has no keys; changes cannot be applied to it")
        schema = T.StructType.fromJson(json.loads(prev["schema_json"]))
        data = changes.drop(*Y.CHANGE_COLS)
        Y.require_additive(self.spark.createDataFrame([], schema), data)
        added = [T.StructField(f.name, f.dataType, True) for f in data.schema.fields if f.name not in schema.names]
        schema = T.StructType(schema.fields + added)
        ordered = changes.select(*schema.names, *[F.col(f.name).cast(f.dataType) for f in Y.CHANGE_FIELDS])
        path, n, top = self._write(ordered, name)
        if not n:
            return None
        before = prev["source_version"]
        # Changes may arrive out of version order; the copy's version only grows.
        return self._commit(name, "changes", schema, prev, path=path, rows=n, streams=streams,
                            source_version=top if before is None else max(top, before))

    def snapshot(self, name: str, label: str, kind: str = "manual", at=None) -> int:
        """G1: a named version. Nothing is copied: written folders never change.

        At most MAX_MANUAL_SNAPSHOTS manual snapshots of a table; one more raises.
        """
        prev = self.latest(name)
        if prev is None:
            raise KeyError(f"no table {name}")
        if kind == "manual" and self.versions(name).filter("kind = 'snapshot:manual'").count() >= MAX_MANUAL_SNAPSHOTS:
            raise SnapshotLimitError(f"{name} has {MAX_MANUAL_SNAPSHOTS} manual snapshots; delete one first")
        return self._commit(name, f"snapshot:{kind}", T.StructType.fromJson(json.loads(prev["schema_json"])), prev,
                            label=label, at=at)


# --- sync modes (A8-A10) --------------------------------------------------------

def sync_snapshot(store: TableStore, source: DataFrame, name: str, keys: list[str] | None = None,
                  source_version: int | None = None) -> tuple[int, int]:
    """Replace the whole serving copy; returns (version, rows)."""
    v = store.overwrite(source, name, keys=keys, source_version=source_version)
    return v, store.latest(name, v)["rows"]


def sync_triggered(store: TableStore, changes: DataFrame, name: str) -> int | None:
    """A9 on a stored copy: record the changes newer than its source version;
    returns the new version (None when nothing changed)."""
    prev = store.latest(name)
    since = prev["source_version"]
    newer = changes if since is None else changes.filter(F.col("_commit_version") > since)
    return store.append_changes(newer, name, prev=prev)


def sync_continuous(stream: DataFrame, store: TableStore, name: str, checkpoint_location: str,
                    trigger: dict | None = None, query_name: str | None = None):
    """A10: record every micro-batch of a change stream; returns the ``StreamingQuery``.

    Idempotent on (checkpoint, batch id): a batch that was committed before a
    failure is skipped on restart, and a stream with a new checkpoint, whose
    batch ids start again, is not.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        prev = store.latest(name)  # carries the last batch of each stream
        if prev is not None and batch_id <= (prev["streams"] or {}).get(checkpoint_location, -1):
            return
        store.append_changes(batch, name, stream=checkpoint_location, batch_id=batch_id, prev=prev)

    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"availableNow": True})).start()
