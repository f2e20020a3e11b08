"""Hot keys: find the few keys that hold many rows, and join without sending such a key to one task.

Results never depend on what is found here; only the distribution of the work does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key with fewer rows than this fits one task comfortably; the session setting overrides the default.
HOT_ROWS = 2_000_000
HOT_ROWS_SETTING = "stratamart.hotRows"
# Heaviest keys considered.  Beyond rank n a key holds less than 1/n of all rows, so the list may be short.
MAX_HOT_KEYS = 1_000
# Items that a heavy-hitter sketch tracks: keys with more than a few 100,000ths of all rows are found.
TRACKED = 100_000
# Parts into which rows without key are dealt.
SALTS = 64

_HASH, _SALT, _SALTS = "__hash", "__salt", "__salts"


_SKEWED_PARTITION = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"


def _threshold_bytes(df: DataFrame, name: str) -> int:
    text = df.sparkSession.conf.get(name)
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)) \
        if not text.lstrip("-").isdigit() else int(text)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate of the frame is within the session's broadcast threshold."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= _threshold_bytes(df, "spark.sql.autoBroadcastJoinThreshold")


def may_be_skewed(df: DataFrame) -> bool:
    """Whether the inputs of the frame are larger than what AQE already calls a skewed partition.

    Below that size not even one key holding every row is worth a pass to look for it.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return read > _threshold_bytes(df, _SKEWED_PARTITION)


def hot_keys(df: DataFrame, key: Sequence[str], min_rows: int | None = None) -> DataFrame:
    """The at most MAX_HOT_KEYS heaviest non-null keys having at least ``min_rows`` rows.

    One pass over the key columns with map-side counting.  The result is a driver-made frame of bounded
    size, so broadcasting it is safe and a plan can be chosen on whether it is empty.
    """
    if min_rows is None:
        min_rows = int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))
    present = df.select(*key)
    for c in key:
        present = present.filter(F.col(c).isNotNull())
    found = (
        present.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") >= min_rows)
        .orderBy(F.desc("rows"))
        .limit(MAX_HOT_KEYS)
        .collect()
    )
    schema = present.schema
    return df.sparkSession.createDataFrame([tuple(r[c] for c in key) for r in found], schema)


def _key_hash(df: DataFrame, columns: Sequence[str], types: Sequence[T.DataType]) -> Column:
    """One number for a key, NULL if a part of it is; equal for equal keys of both sides of a join, whose types may differ."""
    parts, present = [], F.lit(True)
    for c, data_type in zip(columns, types):
        column = F.col(c) if df.schema[c].dataType == data_type else F.col(c).try_cast(data_type)
        # The two zeros of floating numbers are equal, but not their bits.
        parts.append(column + F.lit(0.0).cast(data_type) if isinstance(data_type, T.FractionalType) else column)
        present = present & column.isNotNull()
    return F.when(present, F.xxhash64(*parts))


def heavy_keys(df: DataFrame, keys: Mapping[str, Sequence[str]], min_rows: int | None = None) -> dict[str, DataFrame]:
    """Keys with at least ``min_rows`` rows, as (hash, parts to deal their rows into), for several keys of a frame in one pass.

    Every task keeps a sketch of fixed size for each key, and sketches are merged, so nothing is shuffled but these.  The
    counts are estimates; a key takes about as many parts as it has ``min_rows`` rows.  The frames are made on the driver
    from at most TRACKED rows each, so broadcasting them is safe.
    """
    if min_rows is None:
        min_rows = int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))
    types = {name: [df.schema[c].dataType for c in columns] for name, columns in keys.items()}
    hashes = df.select(*[_key_hash(df, columns, types[name]).alias(f"h{i}") for i, (name, columns) in enumerate(keys.items())])
    top = "filter(approx_top_k({0}, {1}, {1}), x -> x.item is not null and x.count >= {2})"
    found = hashes.agg(*[F.expr(top.format(c, TRACKED, max(1, min_rows))).alias(c) for c in hashes.columns]).first()
    out = {}
    for i, name in enumerate(keys):
        hashes = pa.array([x["item"] for x in found[i] or []], pa.int64())
        parts = pa.array([max(2, -(-x["count"] // max(1, min_rows))) for x in found[i] or []], pa.int32())
        # An Arrow table becomes a local relation: whether it is empty is known without a job.
        out[name] = df.sparkSession.createDataFrame(pa.table({_HASH: hashes, _SALTS: parts}))
    return out


def _spread(df: DataFrame) -> Column:
    # Stable when a task is run again (a random salt would not be), and equal rows in different input
    # partitions get different values, so copies of one row spread too.
    hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*hashable) + F.spark_partition_id()


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    hot_rows: int | None = None,
    counted: DataFrame | None = None,
    force_salting: bool = False,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Equi join on equally named columns whose left keys may be badly skewed.

    A right side within the session's broadcast threshold goes to Catalyst unchanged, which broadcasts it
    (no shuffle, no skew), and so does a left side too small to be skewed.  Beyond that, rows of hot left keys and of NULL keys
    get a salt; the right rows of the hot keys, and only those, are repeated once per salt, a key with more rows more often.
    Every left row still meets every right row of its key, so inner, left, left_semi and left_anti joins are exact.

    Hot keys are found on ``left`` (`heavy_keys`); where that is expensive to compute, ``counted`` names a cheaper frame
    with the same key columns, such as the table ``left`` was derived from, and ``heavy`` hands in what was found already.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot salt a {how} join")
    on = list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash and how in ("inner", "left"):
        raise ValueError(f"columns on both sides that are not joined on: {sorted(clash)}")
    if not force_salting and not needs_salting(left, right):
        return left.join(right, on, how)
    if heavy is None:
        heavy = heavy_keys(left if counted is None else counted, {"": on}, hot_rows)[""]
    if how in ("inner", "left_semi") and heavy.isEmpty():
        # Rows without key go nowhere, so there is nothing to deal out, and a left side dealt by the key stays where it is.
        return left.join(right, on, how)
    types = [left.schema[c].dataType for c in on]
    has_null = F.lit(False)
    for c in on:
        has_null = has_null | F.col(c).isNull()
    marked = F.broadcast(heavy)
    salt = F.when(has_null, F.pmod(_spread(left), F.lit(SALTS))).when(
        F.col(_SALTS).isNotNull(), F.pmod(_spread(left), F.col(_SALTS))).otherwise(F.lit(0))
    salted_left = left.withColumn(_HASH, _key_hash(left, on, types)).join(marked, _HASH, "left").withColumn(
        _SALT, salt.cast("int")).drop(_HASH, _SALTS)
    copies = F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)
    salted_right = right.withColumn(_HASH, _key_hash(right, on, types)).join(marked, _HASH, "left").withColumn(
        _SALT, F.explode(copies)).drop(_HASH, _SALTS)
    joined = salted_left.join(salted_right, [*on, _SALT], how).drop(_SALT)
    kept_right = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on]
    return joined.select(*left.columns, *kept_right)


def needs_salting(left: DataFrame, right: DataFrame) -> bool:
    return not fits_broadcast(right) and may_be_skewed(left)
