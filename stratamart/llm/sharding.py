"""Sharding by vector bin packing: bytes, tokens and rows of all shards are balanced together.

Rows with equal texts form a group. Groups (largest first) are placed one by one in the shard where the dot product of
the group's demand with the shard's residual capacity is highest; demands and capacities are shares of the totals. A group
of many copies is first split into parts that are small against a shard. Placement runs in cells: every part is dealt to
a cell by hash, each cell has a sixteenth (in general 1/shards) of its own totals as capacity for each shard, and ends with
its smallest parts, so the cells' remainders are tiny and add up to near-equal shards. A cell holds about ``cell_parts``
parts whatever the size of the input.

Numbers within a shard (slots) are gapless: rows are counted in buckets of bounded size, and each bucket starts where the
sum of those before it ends.

Tokens are estimated by the number of white-space separated runs, or taken from a column. Defined results: a null text has
size 1 and no tokens and is equal to other null texts; repeated rows are rows of their own; an empty table gives an empty
table; other columns are not read. The law that holds is ``bytes``: shard sizes are near equal.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import BROADCAST_ROWS, blob_hash, staged

BUCKET_ROWS = 100_000


WEIGHTS = (16.0, 1.0, 1.0)
"""Weights of bytes, tokens and rows in the dot product; the law is about bytes."""


def place(demands: np.ndarray, shards: int, weights: tuple[float, ...] = WEIGHTS) -> np.ndarray:
    """Shard of each item (rows of ``demands``); the items come largest first."""
    totals = np.maximum(demands.sum(axis=0), 1e-12)
    share = demands / totals
    left = np.full((shards, demands.shape[1]), 1.0 / shards)
    out = np.empty(len(share), np.int32)
    for i, item in enumerate(share):
        shard = int(np.argmax(left @ (item * weights)))
        left[shard] -= item
        out[i] = shard
    return out


def _placed(parts: DataFrame, cells: int, shards: int) -> DataFrame:
    schema = "t1 long, t2 long, part long, shard int"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        demands = rows[["bytes", "tokens", "rows"]].to_numpy(float)
        order = np.lexsort((rows["part"], rows["t2"], rows["t1"], -demands[:, 2], -demands[:, 0]))
        rows = rows.iloc[order]
        return rows[["t1", "t2", "part"]].assign(shard=place(demands[order], shards))

    cell = F.pmod(F.xxhash64("t1", "t2", "part"), F.lit(cells))
    return parts.withColumn("cell", cell).groupBy("cell").applyInPandas(run, schema)


def with_slots(rows: DataFrame, total: int, shards: int, shard: str = "shard", row: str = "row") -> DataFrame:
    """Add ``slot``: gapless from 0 in each shard. ``row`` numbers the rows uniquely."""
    buckets = max(1, -(-total // BUCKET_ROWS))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(row), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(shard, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(shard).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    if shards * buckets <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    inside = Window.partitionBy(shard, "bucket").orderBy(row)
    return (dealt.withColumn("at", F.row_number().over(inside) - 1).join(starts, [shard, "bucket"])
            .withColumn("slot", F.col("start") + F.col("at")).drop("bucket", "at", "start"))


def shard_documents(df: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", tokens: str | None = None,
                    cell_parts: int = 20_000) -> DataFrame:
    """key, size (bytes + 1), tokens, text_crc32, law, shard, slot and grown_shard (null: the law is not by key)."""
    body = F.coalesce(F.col(text), F.lit(""))
    gaps = F.char_length(body) - F.char_length(F.replace(F.replace(body, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    estimate = F.when(F.trim(body) == "", 0).otherwise(gaps + 1)
    items = staged(df.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("k"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        (F.col(tokens) if tokens else estimate).cast("long").alias("tokens"), F.crc32(body).alias("crc"),
        *[c.alias(n) for c, n in zip(blob_hash(body), ("t1", "t2"))]), "items")
    groups = items.groupBy("t1", "t2").agg(F.count("*").alias("copies"), F.sum("size").alias("bytes"))
    whole = groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
                       F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    cells = max(1, -(-whole["groups"] // cell_parts))
    fair_rows, fair_bytes = (max(1.0, whole[x] / (16 * shards * cells)) for x in ("rows", "bytes"))
    parts_of = F.ceil(F.greatest(F.col("copies") / fair_rows, F.col("bytes") / fair_bytes))
    split = groups.select("t1", "t2", F.least(parts_of, F.col("copies")).alias("parts")).where("parts > 1")
    if 32 * shards * cells <= BROADCAST_ROWS:  # no more groups than that hold a fair part of rows or of bytes
        split = F.broadcast(split)
    items = items.join(split, ["t1", "t2"], "left").withColumn(
        "part", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("row"), F.col("parts"))))
    parts = items.groupBy("t1", "t2", "part").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    dealt = items.join(_placed(parts, cells, shards).hint("shuffle_hash"), ["t1", "t2", "part"])
    return with_slots(dealt, whole["rows"], shards).select(
        F.col("k").alias(key), "size", "tokens", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
