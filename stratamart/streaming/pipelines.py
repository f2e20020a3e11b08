"""A declared pipeline as a stream: every micro-batch goes through the raw, the cleaned and further tables.

A ledger beside the tables holds the ingest time of each micro-batch, set when it is first seen, and the steps that are done. A
micro-batch that runs again, after a stop at any point, gets the same time, skips what is done and repeats the step that broke
off; every step is a `save`, which leaves a table as it was when it is repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from stratamart.functions.scalars import utc_datetime, utc_micros
from stratamart.plans.runs import clean, land
from stratamart.sources.files import delete_path, matching_paths, path_exists, read_note, write_note
from stratamart.spec import Pipeline
from stratamart.streaming.micro_batch import BatchHandler

# Work of a micro-batch after its cleaned table: (session, batch number, ingest time).
Step = Callable[[SparkSession, int, datetime], None]


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class BatchLedger:
    """Times and finished steps of the micro-batches of one stream."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _batches(self) -> list[int]:
        return sorted(int(p.rsplit("/batch=", 1)[1].split("/")[0]) for p in matching_paths(self.spark, f"{self.path}/batch=*/time"))

    def time_of(self, batch_id: int, clock: Callable[[], datetime] = now) -> datetime:
        """The ingest time of a micro-batch: set once, and later than that of the one before."""
        path = f"{self.path}/batch={batch_id}/time"
        known = read_note(self.spark, path)
        if known is None:
            at = utc_micros(clock())
            older = [b for b in self._batches() if b < batch_id]
            if older:
                at = max(at, int(read_note(self.spark, f"{self.path}/batch={older[-1]}/time")) + 1)
            known = str(at)
            write_note(self.spark, path, known)
        return utc_datetime(int(known))

    def done(self, batch_id: int, step: str) -> bool:
        return path_exists(self.spark, f"{self.path}/batch={batch_id}/{step}.done")

    def finish(self, batch_id: int, step: str) -> None:
        write_note(self.spark, f"{self.path}/batch={batch_id}/{step}.done", "")

    def trim(self, keep: int = 100) -> None:
        """Forget all but the newest batches; Spark repeats the last one only."""
        for old in self._batches()[:-keep]:
            delete_path(self.spark, f"{self.path}/batch={old}")


def pipeline_into(
    pipeline: Pipeline,
    root: str,
    *,
    name: str | None = None,
    then: Sequence[tuple[str, Step]] = (),
    clock: Callable[[], datetime] = now,
) -> BatchHandler:
    """Micro-batches of source rows into the tables of a pipeline, and then into others, step by step.

    ``name`` tells streams apart that write below one root; it is also the writer in the ledgers of the tables.
    """
    name = name or pipeline.name

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = BatchLedger(spark, f"{root.rstrip('/')}/streams/{name}")
        at = ledger.time_of(batch_id, clock)
        steps: list[tuple[str, Step]] = [
            ("raw", lambda s, b, t: land(s, pipeline, root, batch, b, t)),
            ("clean", lambda s, b, t: clean(s, pipeline, root, b, t, writer=name)),
            *then,
        ]
        for step, work in steps:
            if not ledger.done(batch_id, step):
                work(spark, batch_id, at)
                ledger.finish(batch_id, step)
        ledger.trim()

    return handle
