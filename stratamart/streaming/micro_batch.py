"""Landing folder -> raw table -> cleaned table, one micro-batch at a time.

Every micro-batch is first written to the raw table under its own batch id and read back from there: the
source files are parsed once, and a micro-batch that is run again replaces what its first attempt wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratamart.sources.tables import PartitionedTable, Scd2Table, SnapshotTable, write_files
from stratamart.spec import INGEST_TS

STREAM_BATCH = "stream_batch"

BatchHandler = Callable[[DataFrame, int], None]


def landed_stream(
    spark: SparkSession, landing: str, schema: T.StructType, *, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    """Files appearing in a landing folder, oldest first."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing)


def into_raw(raw_path: str, handler: BatchHandler) -> BatchHandler:
    """Wrap a handler so that it sees the stored copy of each micro-batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{raw_path.rstrip('/')}/{STREAM_BATCH}={batch_id}"
        write_files(batch, path)
        handler(spark.read.schema(batch.schema).parquet(path), batch_id)

    return handle


def upsert_into(
    table: SnapshotTable | PartitionedTable,
    key: Sequence[str],
    *,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    version: str = INGEST_TS,
    order_by: Sequence[str] = (),
) -> BatchHandler:
    """Merge micro-batches by key.  The version column decides, so the order of arrival does not matter."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch)
        if isinstance(table, PartitionedTable):
            table.merge(rows, key, version=version, order_by=order_by)
        else:
            table.merge(rows, key, batch_id, version=version, order_by=order_by)

    return handle


def scd2_into(
    table: Scd2Table,
    key: Sequence[str],
    change: Sequence[str],
    *,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    order_by: Sequence[str] = (),
    ts: str = INGEST_TS,
    raw_path: str | None = None,
) -> BatchHandler:
    """Fold micro-batches into a type 2 table, whatever ingest times they hold and in whatever order these come.

    ``raw_path`` is that of `into_raw`: a late row needs the landed rows of its key that came after it.  Without it a file
    that is late counts against the stored versions only (see `splice_scd2`).
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        landed = None
        if raw_path is not None:
            landed = transform(batch.sparkSession.read.schema(batch.schema).parquet(raw_path).select(*batch.columns))
        table.splice(transform(batch), key, change, batch_id, ts=ts, observed=landed, order_by=order_by)

    return handle


def start(
    stream: DataFrame, handler: BatchHandler, checkpoint: str, *, every: str | None = "60 seconds"
) -> StreamingQuery:
    """Run the handler on every micro-batch; ``every=None`` processes what has landed and stops."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
