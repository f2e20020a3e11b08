"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_SLICE = 256
"""Rows of an Arrow batch that are turned into Python objects at a time."""


class Memo(dict):
    """A bounded cache: ``memo[key]`` computes what is absent.

    Two generations of ``limit`` entries: when the young one is full it becomes the old one, and entries that are asked
    for again move back. Keys longer than ``longest`` are computed each time, so memory has a bound.
    """

    def __init__(self, compute: Callable, limit: int = 300_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest, self.old = compute, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def map_slices(df: DataFrame, factory: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``factory()`` (made once in each task) to small slices of each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_SLICE):
                out = work(batch.slice(start, ROWS_PER_SLICE))
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """The strings of a column, null as the empty string."""
    return [t or "" for t in column.to_pylist()]


_recorders: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Note in ``paths`` where the tables lie that are staged meanwhile."""
    _recorders.append(paths)
    try:
        yield
    finally:
        _recorders.remove(paths)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables; whatever was computed from them has to be stored by now."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so that lineage ends and executors may be lost.

    The folder is ``spark.checkpoint.dir`` of the session (or the one set on the context). Only a session without either,
    as in tests, gets a folder below the warehouse. One table is one new folder; the session's owner clears the shared
    folder, as with checkpoints, unless the caller records what is staged and releases it.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for paths in _recorders:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 200_000


def small_or_joined(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored table of narrow rows for broadcast if it has at most ``rows`` of them; else Spark joins by shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def blob_hash(*columns) -> list:
    """Two independent 64-bit hashes; together they identify a text (128 bits)."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(0x5DEECE66D), *columns)]
