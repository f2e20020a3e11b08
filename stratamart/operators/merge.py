"""Keyed merge as DataFrame algebra: upsert, delete, and what each of them did."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.keys import packed
from stratamart.operators.audit import LoadCounts, watch_actions
from stratamart.operators.conform import drop_null_keys, evolve
from stratamart.operators.dedupe import one_row_per_key
from stratamart.operators.pairing import paired


def _newer(stored: Column, incoming: Column) -> Column:
    """Stored version beats the incoming one; a NULL version is older than any other."""
    return stored.isNotNull() & (incoming.isNull() | (stored > incoming))


def prepared(source: DataFrame, key: Sequence[str], order_by: Sequence[str], on_duplicate: str = "latest",
             counts: LoadCounts | None = None) -> DataFrame:
    """A batch as the merges need it: no NULL keys, one row per key.

    ``counts`` gets the rows of the batch and those without key.
    """
    if counts is None:
        return one_row_per_key(drop_null_keys(source, key), key, order_by, on_duplicate=on_duplicate)
    # Rows without key are groups like any other until they have been counted.
    chosen = one_row_per_key(source, key, order_by, on_duplicate=on_duplicate, rows="__rows")
    keyless = F.lit(False)
    for c in key:
        keyless = keyless | F.col(c).isNull()
    chosen = counts.watch(chosen, rows_read=F.sum("__rows"), rows_rejected=F.sum(F.when(keyless, F.col("__rows"))))
    return drop_null_keys(chosen, key).drop("__rows")


def compared(target: DataFrame, source: DataFrame, key: Sequence[str], version: str | None = None) -> dict[str, int]:
    """What an upsert of ``source`` would do, from keys and versions alone: numbers of rows ``read`` and ``rejected`` (no
    key), of keys that are ``repeated`` in the source, and of keys to ``insert``, ``update``, ``ignore`` or ``keep``.

    One row per key and task is shuffled, text keys packed.  Repeated keys count with their greatest version.
    """
    key = list(key)
    text = [c for c in key if target.schema[c].dataType == source.schema[c].dataType == T.StringType()]

    def narrow(df: DataFrame, tag: str, other: str) -> DataFrame:
        at = F.col(version).alias(f"{tag}v") if version else F.lit(None).cast("int").alias(f"{tag}v")
        return df.select(*[packed(F.col(c)).alias(c) if c in text else c for c in key], F.lit(1).cast("long").alias(tag), F.lit(0).cast("long").alias(other), at)

    both = narrow(source, "__s", "__t").unionByName(narrow(target, "__t", "__s"), allowMissingColumns=True)
    keys = both.groupBy(*key).agg(*[f(c).alias(c) for f, c in ((F.sum, "__s"), (F.sum, "__t"), (F.max, "__sv"), (F.max, "__tv"))])
    keyless = F.lit(False)
    for c in key:
        keyless = keyless | F.col(c).isNull()
    sent, known = ~keyless & (F.col("__s") > 0), F.col("__t") > 0
    older = _newer(F.col("__tv"), F.col("__sv")) if version else F.lit(False)
    counted = {
        "read": F.sum("__s"), "rejected": F.sum(F.when(keyless, F.col("__s"))), "repeated": F.count_if(sent & (F.col("__s") > 1)),
        "insert": F.count_if(sent & ~known), "update": F.count_if(sent & known & ~older),
        "ignore": F.count_if(sent & known & older), "keep": F.count_if(known & (F.col("__s") == 0)),
    }
    return keys.agg(*[F.coalesce(c, F.lit(0)).alias(name) for name, c in counted.items()]).first().asDict()


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    *,
    order_by: Sequence[str] = (),
    version: str | None = None,
    on_duplicate: str = "latest",
    allow_new_columns: bool = True,
    key_range: str | None = None,
    unique: bool = False,
    deletes: DataFrame | None = None,
    counts: LoadCounts | None = None,
) -> DataFrame:
    """Rows of ``source`` replace or join those of ``target``; all other target rows stay, but for the keys of ``deletes``.

    With a batch inside the broadcast threshold the target is not shuffled at all.  ``version`` makes the
    order of arrival irrelevant: an older source row is ignored.  ``key_range`` names a key column; target
    rows outside the batch's range of it bypass the join.  ``unique`` says that the source is `prepared`.
    ``counts`` watches what happens to the keys.
    """
    key = list(key)
    ranked = [version, *[c for c in order_by if c != version]] if version else list(order_by)
    source = source if unique else prepared(source, key, ranked, on_duplicate)
    if allow_new_columns:
        target, source = evolve(target, source)
    else:
        source = source.select(*target.columns)

    bypass = None
    if key_range is not None and deletes is None:
        low, high = source.agg(F.min(key_range), F.max(key_range)).first()
        if low is None:
            inside = F.lit(False)
        else:
            inside = F.coalesce(F.col(key_range).between(F.lit(low), F.lit(high)), F.lit(False))
        bypass, target = target.filter(~inside), target.filter(inside)

    if version is None and counts is None:
        merged = target.join(source.select(*key), key, "left_anti").unionByName(source)
    else:
        pairs, older = paired(target, source, key), F.lit(False)
        if version is not None:
            older = _newer(F.col(f"t.{version}"), F.col(f"s.{version}"))
        action = F.when(F.col("s").isNull(), "keep").when(F.col("t").isNull(), "insert").when(older, "ignore").otherwise("update")
        if counts is not None:
            pairs = pairs.withColumn("action", action)
            if deletes is not None:
                gone = drop_null_keys(deletes.select(*key), key).distinct().withColumn("__gone", F.lit(True))
                pairs = pairs.join(gone, key, "left")
            hit = None if deletes is None else F.col("__gone").isNotNull()
            pairs = watch_actions(counts, pairs, ("insert", "update", "ignore"), hit)
            if deletes is not None:
                pairs, deletes = pairs.filter(F.col("__gone").isNull()), None
        winner = F.when(action.isin("keep", "ignore"), F.col("t")).otherwise(F.col("s"))
        merged = pairs.select(winner.alias("row")).select("row.*")
    if deletes is not None:
        merged = delete_keys(merged, deletes, key)
    return merged if bypass is None else bypass.unionByName(merged)


def delete_keys(target: DataFrame, deletes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target without the listed keys; NULL keys in the list delete nothing."""
    return target.join(deletes.select(*key), list(key), "left_anti")


def merge_actions(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    *,
    order_by: Sequence[str] = (),
    version: str | None = None,
    deletes: DataFrame | None = None,
) -> DataFrame:
    """What `upsert` (then `delete_keys`) does with each key: column ``action`` next to the key columns.

    Only keys of the batch and of the deletes come out: insert, update, ignore (older), delete.
    """
    key = list(key)
    ranked = [version, *[c for c in order_by if c != version]] if version else list(order_by)
    source = prepared(source, key, ranked)
    version_of = F.col(version) if version else F.lit(None).cast("timestamp")
    incoming = source.select(*key, version_of.alias("__incoming"))
    hit = target.select(*key, version_of.alias("__stored"), F.lit(True).alias("__hit")).join(
        incoming.select(*key), key, "left_semi"
    )
    older = _newer(F.col("__stored"), F.col("__incoming")) if version else F.lit(False)
    action = F.when(F.col("__hit").isNull(), "insert").when(older, "ignore").otherwise("update")
    actions = incoming.join(hit, key, "left").select(*key, action.alias("action"))
    if deletes is not None:
        gone = drop_null_keys(deletes.select(*key), key).distinct()
        known = target.select(*key).unionByName(incoming.select(*key)).join(gone, key, "left_semi").distinct()
        actions = actions.unionByName(known.select(*key, F.lit("delete").alias("action")))
    return actions
