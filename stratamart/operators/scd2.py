"""Slowly changing dimensions, type 2: one batch at a time, or the whole history at once.

Versions are half-open intervals [scd_start_ts, scd_end_ts); an open version has a NULL end.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.scalars import utc_literal
from stratamart.operators.audit import LoadCounts, watch_actions
from stratamart.operators.conform import conform, drop_null_keys, evolve, merged_schema
from stratamart.operators.dedupe import one_row_per_key
from stratamart.operators.pairing import paired
from stratamart.operators.skew import hot_keys, may_be_skewed
from stratamart.spec import SCD_COLUMNS, SCD_CURRENT, SCD_END, SCD_START

# Time slices a hot key's history is cut into.
SLICES = 64
# From when on a late row changes the history of its key.
REVISED_FROM = "revised_from_ts"
# What an event of a splice is.
_KIND = "__kind"
_VERSION, _END, _LATE, _OBSERVED = range(4)


def attributes(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in SCD_COLUMNS]


def empty_history(batch: DataFrame) -> DataFrame:
    """A table without versions that fits ``batch``: lets the first load and later ones share one plan."""
    fields = [T.StructField(f.name, f.dataType, True) for f in batch.schema.fields]
    fields += [
        T.StructField(SCD_START, T.TimestampType()),
        T.StructField(SCD_END, T.TimestampType()),
        T.StructField(SCD_CURRENT, T.BooleanType()),
    ]
    return batch.sparkSession.createDataFrame([], T.StructType(fields))


def _action(change: Sequence[str]) -> Column:
    same = F.struct(*[F.col(f"t.{c}") for c in change]).eqNullSafe(F.struct(*[F.col(f"s.{c}") for c in change]))
    action = F.when(F.col("t").isNull(), "insert").when(F.col("s").isNull(), "keep")
    return action.when(same, "unchanged").otherwise("change")


def paired_actions(
    current: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    change: Sequence[str],
    *,
    order_by: Sequence[str] = (),
    deletes: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Open versions against a batch: ``key``, ``t``, ``s`` and ``action``.

    Actions: insert, change, unchanged, keep (absent from the batch), close (deleted and not in the batch).
    ``unique`` says that the batch has one row per key already.
    """
    key = list(key)
    batch = batch if unique else one_row_per_key(drop_null_keys(batch, key), key, order_by)
    schema = merged_schema(current.select(*attributes(current)).schema, batch.schema)
    scd = T.StructType([current.schema[c] for c in SCD_COLUMNS])
    current = conform(current, T.StructType(schema.fields + scd.fields))
    pairs = paired(current, conform(batch, schema), key).withColumn("action", _action(change))
    if deletes is not None:
        gone = drop_null_keys(deletes.select(*key), key).distinct().withColumn("__gone", F.lit(True))
        closing = F.col("__gone").isNotNull() & F.col("action").isin("keep")
        pairs = (
            pairs.join(gone, key, "left")
            .withColumn("action", F.when(closing, "close").otherwise(F.col("action")))
            .drop("__gone")
        )
    return pairs


def apply_scd2(
    current: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    change: Sequence[str],
    batch_ts: datetime,
    *,
    order_by: Sequence[str] = (),
    overwrite: Sequence[str] = (),
    deletes: DataFrame | None = None,
    unique: bool = False,
    counts: LoadCounts | None = None,
) -> DataFrame:
    """All open versions after the batch, plus the versions the batch closed (``scd_is_current`` tells them).

    ``current`` holds open versions only, so the cost follows the live keys, not the history.  A batch not
    newer than an open version it would change fails the job (StaleBatch); rebuild the history instead.
    """
    pairs = paired_actions(current, batch, key, change, order_by=order_by, deletes=deletes, unique=unique)
    if counts is not None:
        pairs = watch_actions(counts, pairs, ("insert", "change", "unchanged", "close"))
    names = [c for c in pairs.schema["s"].dataType.names]
    ts = utc_literal(batch_ts)
    ends = F.col("action").isin("change", "close")
    stale = F.raise_error(
        F.concat(F.lit("StaleBatch: batch of "), ts.cast("string"),
                 F.lit(" would change a version open since "), F.col(f"t.{SCD_START}").cast("string"))
    ).cast("timestamp")
    end = F.when(ends & (F.col(f"t.{SCD_START}") >= ts), stale).otherwise(ts)

    refreshed = [
        F.when(F.col("action") == "unchanged", F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        if c in overwrite else F.col(f"t.{c}").alias(c)
        for c in names
    ]
    row_type = T.StructType(
        [T.StructField(c, pairs.schema["s"].dataType[c].dataType) for c in names]
        + [T.StructField(SCD_START, T.TimestampType()), T.StructField(SCD_END, T.TimestampType()),
           T.StructField(SCD_CURRENT, T.BooleanType())]
    )
    no_end = F.lit(None).cast("timestamp")
    opened = F.struct(*[F.col(f"s.{c}").alias(c) for c in names],
                      ts.alias(SCD_START), no_end.alias(SCD_END), F.lit(True).alias(SCD_CURRENT)).cast(row_type)
    kept = F.struct(*refreshed, F.col(f"t.{SCD_START}").alias(SCD_START), no_end.alias(SCD_END),
                    F.lit(True).alias(SCD_CURRENT)).cast(row_type)
    closed = F.struct(*[F.col(f"t.{c}").alias(c) for c in names], F.col(f"t.{SCD_START}").alias(SCD_START),
                      end.alias(SCD_END), F.lit(False).alias(SCD_CURRENT)).cast(row_type)
    # One pass writes both kinds of rows: a changed key yields two, every other key one.
    rows = (
        F.when(F.col("action") == "insert", F.array(opened))
        .when(F.col("action") == "change", F.array(closed, opened))
        .when(F.col("action") == "close", F.array(closed))
        .otherwise(F.array(kept))
    )
    return pairs.select(F.inline(rows))


def rebuild_scd2(
    batches: DataFrame,
    key: Sequence[str],
    change: Sequence[str],
    ts: str,
    *,
    order_by: Sequence[str] = (),
    hot_rows: int | None = None,
    grouped: bool = False,
) -> DataFrame:
    """The whole history from all batches at once; equal to folding them one by one in ``ts`` order.

    A version carries the attributes of the row that opened it.  Each ordinary key is one window group; the
    history of a hot key is cut into time slices so that no task gets all of it, and the few slice edges
    are matched separately.  ``grouped`` says that the rows lie together by key and that no key is hot.
    """
    key = list(key)
    batches = drop_null_keys(batches, [*key, ts])
    hot = hot_keys(batches, key, hot_rows) if not grouped and may_be_skewed(batches) else None
    even = hot is None or hot.isEmpty()
    # Without hot keys everything below needs the rows grouped by key only, so they are shuffled once.
    rows = one_row_per_key(batches.repartition(*key) if even and not grouped else batches, [*key, ts], order_by)
    # A struct: NULL from lag() then means "no earlier row", never "all attributes NULL".
    rows = rows.withColumn("__now", F.struct(*change))
    if even:
        order = Window.partitionBy(*key).orderBy(ts)
        before = F.lag("__now").over(order)
        starts = rows.withColumn("__before", before).filter(_opens()).drop("__before")
        starts = starts.withColumn(SCD_END, F.lead(ts).over(order))
    else:
        starts = _sliced_starts(rows, key, ts, hot)
    columns = [c for c in batches.columns if c != ts]
    return starts.select(
        *columns,
        F.col(ts).cast("timestamp").alias(SCD_START),
        F.col(SCD_END).cast("timestamp").alias(SCD_END),
        F.col(SCD_END).isNull().alias(SCD_CURRENT),
    )


def first_changes(rows: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """Keys of a batch, each with the earliest time at which the batch says something about it."""
    return rows.groupBy(*key).agg(F.min(ts).alias(REVISED_FROM))


def reached(history: DataFrame, firsts: DataFrame, key: Sequence[str], since: datetime) -> DataFrame:
    """Versions that rows from ``firsts`` on may change: open, or closed at that time or later.

    ``since`` is the least of these times, as a literal for the scan.  A version that ends exactly there may go on if the
    row says the same.
    """
    late = F.col(SCD_END).isNull() | (F.col(SCD_END) >= utc_literal(since))
    near = history.filter(late).join(firsts, list(key))
    return near.filter(F.col(SCD_END).isNull() | (F.col(SCD_END) >= F.col(REVISED_FROM)))


def splice_scd2(
    cut: DataFrame,
    rows: DataFrame,
    key: Sequence[str],
    change: Sequence[str],
    ts: str,
    *,
    observed: DataFrame | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The versions that take the place of ``cut`` (see `reached`) once ``rows`` are known too, whatever their order of arrival.

    Versions remember the rows that opened them only.  Rows that came after a late one and changed nothing then may open a
    version now, so ``observed`` gives all rows of these keys from the late ones on; without it the version after a late
    row begins where the next stored one does.  Versions that ended before the first late row of their key take no part.
    A version closed by a deletion stays closed at that time.
    """
    key, alive = list(key), "__alive"
    openers = cut.withColumn(ts, F.col(SCD_START))
    # Where no version of the key follows, a deletion closed the last one: a row that opens nothing visible.
    ends = openers.filter(F.col(SCD_END).isNotNull()).select(*key, F.col(SCD_END).alias(ts))
    closed = ends.join(openers.select(*key, ts), [*key, ts], "left_anti").withColumn(alive, F.lit(False))
    known = openers.drop(*SCD_COLUMNS)
    for more in (rows, observed):
        if more is not None:
            known, more = evolve(known, more)
            known = known.unionByName(more)
    # A row that came together with others of its key and time wins or loses by ``order_by``, as in a rebuild.
    known = one_row_per_key(drop_null_keys(known, [*key, ts]), [*key, ts], order_by).withColumn(alive, F.lit(True))
    events = known.unionByName(closed, allowMissingColumns=True)
    # A key that is in a batch is not closed by that batch's deletions, so a row wins over them.
    spliced = rebuild_scd2(events, key, [*change, alive], ts, order_by=[alive, *order_by])
    return spliced.filter(alive).drop(alive)


def splice_events(
    history: DataFrame,
    rows: DataFrame,
    key: Sequence[str],
    ts: str,
    since: datetime,
    observed: DataFrame | None = None,
) -> DataFrame:
    """All that `splice_at_once` looks at, one row each: versions, their ends, late rows, and rows observed since the first of these."""
    near = F.col(SCD_END).isNull() | (F.col(SCD_END) >= utc_literal(since))
    names = attributes(history)
    kinds = F.when(F.col(SCD_END).isNull(), F.array(F.lit(_VERSION))).otherwise(F.array(F.lit(_VERSION), F.lit(_END)))
    versions = history.filter(near).withColumn(_KIND, F.explode(kinds))
    opens = F.col(_KIND) == _VERSION
    events = versions.select(
        *[F.col(c) if c in key else F.when(opens, F.col(c)).alias(c) for c in names],
        F.when(opens, F.col(SCD_START)).otherwise(F.col(SCD_END)).alias(ts), F.col(SCD_END), F.col(_KIND),
    )
    more = [(rows, _LATE)]
    if observed is not None:
        more.append((observed.filter(F.col(ts) >= utc_literal(since)), _OBSERVED))
    for df, kind in more:
        events, df = evolve(events, df.withColumn(SCD_END, F.lit(None).cast("timestamp")).withColumn(_KIND, F.lit(kind)))
        events = events.unionByName(df)
    return drop_null_keys(events, [*key, ts])


def splice_at_once(events: DataFrame, key: Sequence[str], change: Sequence[str], ts: str, *, order_by: Sequence[str] = ()) -> DataFrame:
    """What `splice_scd2` makes of `splice_events`, next to the open versions of all other keys, in one shuffle by key.

    For batches that are not small against the table.  All events of a key meet in one window group, so no key may be hot.
    """
    key, alive = list(key), "__alive"
    of_key = Window.partitionBy(*key).orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kind, first = F.col(_KIND), F.col(REVISED_FROM)
    # The open version of a key without late rows is its only event that stays, and comes out as it is.
    reached = F.when(kind == _LATE, True).when(kind == _VERSION, F.col(SCD_END).isNull() | (F.col(SCD_END) >= first))
    events = events.withColumn(REVISED_FROM, F.min(F.when(kind == _LATE, F.col(ts))).over(of_key))
    events = events.filter(reached.otherwise(F.col(ts) >= first)).withColumn(alive, kind != _END)
    # Of an end and a row at the same time the row wins: only ends that no version follows close anything.
    spliced = rebuild_scd2(events.drop(SCD_END, _KIND, REVISED_FROM), key, [*change, alive], ts, order_by=[alive, *order_by], grouped=True)
    return spliced.filter(alive).drop(alive)


def _opens() -> Column:
    return F.col("__before").isNull() | ~F.col("__before").eqNullSafe(F.col("__now"))


def _sliced_starts(rows: DataFrame, key: list[str], ts: str, hot: DataFrame) -> DataFrame:
    """Version starts with their ends, window groups being (key, time slice) for hot keys.

    The per-slice frames below have at most MAX_HOT_KEYS * SLICES rows, so they may be broadcast.
    """
    ticks = F.unix_micros(F.col(ts).cast("timestamp"))
    at = [i / SLICES for i in range(1, SLICES)]
    edges = (
        rows.select(*key, ticks.alias("__t")).join(F.broadcast(hot), key, "left_semi")
        .groupBy(*key).agg(F.percentile_approx("__t", at, F.lit(10_000)).alias("__edges"))
    )
    # The edges are approximate quantiles; any edges give the same result, only less even slices.
    slice_no = F.when(F.col("__edges").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter("__edges", lambda e: e < F.col("__t")))
    )
    rows = (
        rows.withColumn("__t", ticks).join(F.broadcast(edges), key, "left")
        .withColumn("__slice", slice_no).drop("__edges", "__t")
    )
    cut = [*key, "__slice"]
    within = Window.partitionBy(*cut).orderBy(ts)
    along = Window.partitionBy(*key).orderBy("__slice")
    is_hot = F.col("__slice") >= 0

    last = rows.filter(is_hot).groupBy(*cut).agg(F.max_by("__now", ts).alias("__last"))
    carried = last.select(*cut, F.lag("__last").over(along).alias("__carried"))
    starts = (
        rows.withColumn("__before", F.lag("__now").over(within))
        .join(F.broadcast(carried), cut, "left")
        .withColumn("__before", F.coalesce("__before", "__carried"))
        .filter(_opens())
        .drop("__before", "__carried")
    )
    first = starts.filter(is_hot).groupBy(*cut).agg(F.min(ts).alias("__first"))
    following = first.select(*cut, F.lead("__first").over(along).alias("__following"))
    return (
        starts.withColumn(SCD_END, F.lead(ts).over(within))
        .join(F.broadcast(following), cut, "left")
        .withColumn(SCD_END, F.coalesce(SCD_END, "__following"))
    )
