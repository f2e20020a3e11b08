"""Type 2 histories: folded batch by batch, rebuilt at once, read as current, closed by deletes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.scalars import utc_literal
from stratamart.operators.dedupe import one_row_per_key
from stratamart.operators.scd2 import rebuild_scd2
from stratamart.registry.inputs import ids, scd2_sql, shown, sql_ts, table
from stratamart.registry.keyed import NEWEST, batch_of, customer_orders, raw_orders
from stratamart.sources.tables import PartitionedTable, Scd2Table, append_batch, scratch_dir
from stratamart.spec import INGEST_TS

KEY, CHANGE = ["o_custkey"], ["o_orderpriority"]


def _priorities(raw: DataFrame) -> DataFrame:
    """Priority of the last order of every customer and batch."""
    rows = raw.select("o_custkey", INGEST_TS, "o_orderdate", "o_orderkey", "o_orderpriority")
    return one_row_per_key(rows, ["o_custkey", INGEST_TS], NEWEST).drop("o_orderdate")


def folded(spark: SparkSession, sf_dir: str) -> Scd2Table:
    raw, batches = raw_orders(spark, sf_dir)
    history = Scd2Table(spark, scratch_dir(spark))
    for number, at in enumerate(batches):
        history.apply(_priorities(batch_of(raw, at)).drop(INGEST_TS), KEY, CHANGE, number, at)
    return history


def scd2_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(folded(spark, sf_dir).history())


def scd2_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = customer_orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", INGEST_TS)
    return shown(rebuild_scd2(orders, KEY, CHANGE, INGEST_TS, order_by=NEWEST).drop("o_orderdate"))


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(folded(spark, sf_dir).current())


def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions valid at the middle of 1998: later batches do not matter."""
    at = F.lit("1998-07-01").cast("timestamp")
    history = folded(spark, sf_dir).history()
    valid = (F.col("scd_start_ts") <= at) & (F.col("scd_end_ts").isNull() | (F.col("scd_end_ts") > at))
    return shown(history.filter(valid).select("o_custkey", "o_orderkey", "o_orderpriority", "scd_start_ts"))


def scd2_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch also closes the versions of customers in debt that it does not contain."""
    raw, batches = raw_orders(spark, sf_dir)
    debtors = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("o_custkey"))
    history = Scd2Table(spark, scratch_dir(spark))
    for number, at in enumerate(batches):
        deletes = debtors if at == batches[-1] else None
        history.apply(_priorities(batch_of(raw, at)).drop(INGEST_TS), KEY, CHANGE, number, at, deletes=deletes)
    return shown(history.history())


def unordered(batches: list) -> list:
    """An order of arrival in which every other batch comes late."""
    return batches[::2] + batches[1::2][::-1]


def scd2_late_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly batches in a mixed order of arrival; each is spliced into the history of what had come before."""
    # Landed as one row per customer and batch, so that what was taken in is not reduced again for every late batch.
    path, orders = scratch_dir(spark), _priorities(customer_orders(spark, sf_dir))
    append_batch(orders, path, [INGEST_TS], rebalance=True)
    landed = PartitionedTable(spark, path, [INGEST_TS], orders.schema).read()
    history, arrived = Scd2Table(spark, scratch_dir(spark)), []
    for number, at in enumerate(unordered(ids(landed, INGEST_TS))):
        seen = landed.filter(F.col(INGEST_TS).isin(*map(utc_literal, arrived))) if arrived else None
        history.splice(batch_of(landed, at), KEY, CHANGE, number, ts=INGEST_TS, observed=seen)
        arrived.append(at)
    return shown(history.history())


QUERIES = {
    "scd2_fold": scd2_fold,
    "scd2_late_arrival": scd2_late_arrival,
    "scd2_rebuild": scd2_rebuild,
    "scd2_current": scd2_current,
    "scd2_as_of": scd2_as_of,
    "scd2_delete": scd2_delete,
}

PRIORITIES_SQL = f"""
batches AS (
  SELECT * FROM (
    SELECT o_custkey, o_orderkey, o_orderpriority, date_trunc('year', o_orderdate) AS ingest_ts,
           row_number() OVER (PARTITION BY o_custkey, date_trunc('year', o_orderdate)
                              ORDER BY o_orderdate DESC, o_orderkey DESC) AS pick
    FROM orders) WHERE pick = 1),
history AS ({scd2_sql('batches', 'o_custkey', CHANGE, ['o_custkey', 'o_orderkey', 'o_orderpriority'])})
"""
HISTORY_SQL = f"""
WITH {PRIORITIES_SQL}
SELECT o_custkey, o_orderkey, o_orderpriority, {sql_ts('scd_start_ts')} AS scd_start_ts,
       {sql_ts('scd_end_ts')} AS scd_end_ts, scd_end_ts IS NULL AS scd_is_current
FROM history"""

ORACLES = {
    "scd2_fold": HISTORY_SQL,
    "scd2_late_arrival": HISTORY_SQL,
    "scd2_rebuild": HISTORY_SQL,
    "scd2_current": f"SELECT * FROM ({HISTORY_SQL}) WHERE scd_is_current",
    "scd2_as_of": f"""
WITH {PRIORITIES_SQL}
SELECT o_custkey, arg_max(o_orderkey, scd_start_ts) AS o_orderkey,
       arg_max(o_orderpriority, scd_start_ts) AS o_orderpriority, {sql_ts('max(scd_start_ts)')} AS scd_start_ts
FROM history WHERE scd_start_ts <= TIMESTAMP '1998-07-01' GROUP BY o_custkey""",
    "scd2_delete": f"""
WITH {PRIORITIES_SQL},
last AS (SELECT max(ingest_ts) AS t FROM batches),
versions AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, scd_start_ts,
         CASE WHEN scd_end_ts IS NULL AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
                   AND o_custkey NOT IN (SELECT o_custkey FROM batches, last WHERE ingest_ts = t)
              THEN (SELECT t FROM last) ELSE scd_end_ts END AS scd_end_ts
  FROM history)
SELECT o_custkey, o_orderkey, o_orderpriority, {sql_ts('scd_start_ts')} AS scd_start_ts,
       {sql_ts('scd_end_ts')} AS scd_end_ts, scd_end_ts IS NULL AS scd_is_current
FROM versions""",
}
