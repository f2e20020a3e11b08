"""Load audit: what a merge did, as rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratamart.functions.scalars import utc_literal
from stratamart.spec import AUDIT_COUNTS

ACTIONS = ("insert", "update", "ignore", "delete", "change", "unchanged", "close")


def audit_row(actions: DataFrame, table: str, batch_ts: datetime, kinds: Sequence[str] = ACTIONS) -> DataFrame:
    """One row per load, a count per action; ``actions`` comes from `merge_actions` or `paired_actions`.

    Counting is one global aggregate over an ``action`` column, so only partial counts are shuffled.
    """
    counts = [F.count_if(F.col("action") == kind).alias(f"rows_{kind}") for kind in kinds]
    return actions.agg(*counts).select(
        F.lit(table).alias("table_name"), utc_literal(batch_ts).alias("ingest_ts"),
        *[f"rows_{kind}" for kind in kinds],
    )


class LoadCounts:
    """Counts of one load, observed in the writes that carry it out, so that nothing is read again to be counted.

    Frames are watched in the stage that writes them: its tasks count once each, also where executors are lost and other
    stages run again.
    """

    def __init__(self) -> None:
        self._watched: list[tuple[Observation, list[str]]] = []
        self._known: dict[str, int] = {}

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """The frame, which counts as it is written; it must be written exactly once."""
        seen = Observation(f"load-{uuid.uuid4().hex}")
        self._watched.append((seen, list(counts)))
        return df.observe(seen, *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in counts.items()])

    def add(self, **counts: int) -> None:
        """Counts that are known without a write."""
        for name, n in counts.items():
            self._known[name] = self._known.get(name, 0) + n

    def values(self) -> dict[str, int | None]:
        """What the writes counted, once all of them are done; None for what this kind of load does not have."""
        out: dict[str, int | None] = dict.fromkeys(AUDIT_COUNTS) | self._known
        for seen, names in self._watched:
            found = seen.get  # without entries where the plan turned out to have no rows
            for name in names:
                out[name] = (out.get(name) or 0) + found.get(name, 0)
        return out


def watch_actions(counts: LoadCounts, pairs: DataFrame, kinds: Sequence[str], deleted: Column | None = None) -> DataFrame:
    """Count an ``action`` column by kind and, if given, the rows that a deletion hits."""
    wanted = {f"rows_{kind}": F.count_if(F.col("action") == kind) for kind in kinds}
    if deleted is not None:
        wanted["rows_delete"] = F.count_if(deleted)
    return counts.watch(pairs, **wanted)
