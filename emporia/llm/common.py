"""Helpers shared by the operators: written scratch tables, Arrow loops, bounded caches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from emporia.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a new Parquet table in the shared folder and read it back.

    This cuts lineage: what later jobs read no longer depends on executors
    that may be lost, and no Python stage runs twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]]) -> DataFrame:
    """``mapInArrow`` with a per-task set-up.

    ``make()`` runs once in each task and returns a function from a record
    batch to dicts of columns (lists or arrays), one dict per output batch.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark_schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            step = step or make()
            for cols in step(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c := cols[f.name], pa.Array) else pa.array(c, f.type, from_pandas=False)
                     for f in arrow], schema=arrow)

    return df.mapInArrow(run, spark_schema)


def pieces(n_rows: int, sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose summed sizes stay near ``limit`` (one row at least)."""
    start, total = 0, 0
    for i in range(n_rows):
        if i > start and total + sizes[i] > limit:
            yield start, i
            start, total = i, 0
        total += sizes[i]
    if start < n_rows:
        yield start, n_rows


_MODEL: dict = {}


def worker_model(key, make: Callable):
    """What a Python worker has loaded or built for its tasks: the last one only.

    Workers live on from operator to operator; keeping every operator's tables
    would add them all up. The dropped one's memory goes back to the system.
    """
    if key not in _MODEL:
        _MODEL.clear()
        gc.unfreeze()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)
        _MODEL[key] = make()
        # Memos hold very many small objects and no cycles: looking through them often costs a fifth of the time.
        gc.freeze()
        gc.set_threshold(200_000, 20, 20)
    return _MODEL[key]


class Memo:
    """A memo of bounded size that learns many new keys at once.

    ``learn(keys)`` returns a dict that holds all of them; ``make_many`` gives
    the values of a list of new ones. Two generations are kept: when the
    young one has ``limit`` entries it becomes the old one, so keys in use
    survive and memory stays bounded. Results never depend on it.
    """

    def __init__(self, make_many: Callable[[list], list], limit: int):
        self.make_many, self.limit, self.young, self.old = make_many, limit, {}, {}

    def learn(self, keys) -> dict:
        if len(self.young) >= self.limit:
            self.young, self.old = {}, self.young
        young, old, new = self.young, self.old, []
        for k in keys:
            if k not in young:
                v = old.get(k)
                if v is None:
                    new.append(k)
                else:
                    young[k] = v
        if new:
            young.update(zip(new, self.make_many(new)))
        return young
