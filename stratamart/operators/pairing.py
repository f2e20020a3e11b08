"""Stored rows next to the batch rows of the same key: the join under every merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators.skew import fits_broadcast


def prefer_broadcast(stored: DataFrame, batch: DataFrame) -> bool:
    """A small batch against a large table.  If both are small, one shuffle is cheaper than two reads."""
    return fits_broadcast(batch) and not fits_broadcast(stored)


def paired(stored: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key columns plus structs ``t`` (stored row) and ``s`` (batch row), NULL where absent.

    The structs double as presence flags: an attribute that is NULL is not an absent row.  Both sides are
    unique per key and free of NULL keys, so no key is hot.
    """
    key = list(key)
    t = stored.select(*key, F.struct(*stored.columns).alias("t"))
    s = batch.select(*key, F.struct(*batch.columns).alias("s"))
    if not prefer_broadcast(stored, batch):
        return t.join(s, key, "full_outer")
    # The batch is broadcast, so the stored rows are not shuffled; new keys are found by removing the
    # batch keys that matched, which are never more than the batch has.
    matched = stored.join(F.broadcast(batch.select(*key)), key, "left_semi").select(*key)
    fresh = s.join(F.broadcast(matched), key, "left_anti")
    known = t.join(F.broadcast(s), key, "left")
    return known.unionByName(fresh.withColumn("t", F.lit(None).cast(t.schema["t"].dataType)))
