"""Streams over landed files: results must equal those of the batch queries over the same rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.plans.facts import FACT_BIKE_STATUS
from stratamart.plans.ingestion import CLEAN_STATUS_B, RAW_STATUS_B, STATUS_B, STATUS_B_SOURCE, clean_status_b, status_b_pipeline
from stratamart.plans.loads import load_status_fact
from stratamart.plans.runs import read_table
from stratamart.registry.inputs import STATIONS_SQL, THIRDS, ids, shown, sql_ts, status_b_raw, third_of, third_sql
from stratamart.registry.keyed import batch_of, customer_orders
from stratamart.registry.scd import CHANGE, KEY, ORACLES as SCD_ORACLES, _priorities, unordered
from stratamart.registry.stations import ORACLES as STATION_ORACLES
from stratamart.sources.tables import PartitionedTable, Scd2Table, scratch_dir, staged
from stratamart.spec import INGEST_TS, SOURCE_INGEST_TS, with_ingest_ts
from stratamart.streaming.pipelines import pipeline_into
from stratamart.streaming.micro_batch import BatchHandler, into_raw, landed_stream, scd2_into, start, upsert_into


def _arrive(spark: SparkSession, landing: str, schema: T.StructType, arrivals: Iterable[Sequence[DataFrame]],
            handler: BatchHandler) -> None:
    """Batches that land as JSON files, some at a time; after each time a run of the stream takes in what is new.

    What lands together is one micro-batch however many files it is, so their number, and with it how often the tables are
    rewritten, does not grow with the data.
    """
    checkpoint = scratch_dir(spark)
    for batches in arrivals:
        for batch in batches:
            batch.hint("rebalance").write.mode("append").json(landing)
        start(landed_stream(spark, landing, schema), handler, checkpoint, every=None).awaitTermination()


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed states of source B, cleaned and merged micro-batch by micro-batch into a table by day."""
    raw = staged(status_b_raw(spark, sf_dir))
    third = F.floor((F.dayofmonth(INGEST_TS) - 1) / 11)
    schema = T.StructType([*with_ingest_ts(STATUS_B).fields, T.StructField("day", T.DateType())])
    table = PartitionedTable(spark, scratch_dir(spark), ["day"], schema, follows_key=True)
    handler = upsert_into(
        table, list(CLEAN_STATUS_B.primary_key),
        transform=lambda df: clean_status_b(df).withColumn("day", F.to_date("last_updated")),
    )
    thirds = [[raw.filter(third == i)] for i in range(3)]
    _arrive(spark, scratch_dir(spark), raw.schema, thirds, into_raw(scratch_dir(spark), handler))
    return shown(table.read().drop("day"))


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed order priorities folded into a type 2 table; some years land long after later ones."""
    rows = staged(_priorities(customer_orders(spark, sf_dir)))
    years = [batch_of(rows, at) for at in unordered(ids(rows, INGEST_TS))]
    history, raw_path = Scd2Table(spark, scratch_dir(spark)), scratch_dir(spark)
    handler = into_raw(raw_path, scd2_into(history, KEY, CHANGE, raw_path=raw_path))
    _arrive(spark, scratch_dir(spark), rows.schema, [years[i:i + 2] for i in range(0, len(years), 2)], handler)
    return shown(history.history())


def stream_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed states of source B through the declared tables, raw, cleaned and fact, micro-batch by micro-batch."""
    raw, root, landing = staged(status_b_raw(spark, sf_dir)), scratch_dir(spark), scratch_dir(spark)
    thirds = [raw.filter(third_of(F.col(INGEST_TS)) == i).drop(INGEST_TS) for i in range(3)]
    pipeline, times = status_b_pipeline(lambda s: s.read.schema(STATUS_B_SOURCE).json(landing)), iter(THIRDS)
    fact = ("fact", lambda s, batch_id, at: load_status_fact(s, root, batch_id, at, writer=pipeline.name))
    handler = pipeline_into(pipeline, root, then=[fact], clock=lambda: next(times))
    _arrive(spark, landing, STATUS_B_SOURCE, [[third] for third in thirds], handler)
    landed = read_table(spark, RAW_STATUS_B, root).withColumn("last_updated", F.timestamp_seconds("last_updated"))
    layers = {
        "raw": (landed, "last_updated", "num_bikes_available", INGEST_TS),
        "clean": (read_table(spark, CLEAN_STATUS_B, root), "last_updated", "num_bikes_available", INGEST_TS),
        "fact": (read_table(spark, FACT_BIKE_STATUS, root), "timestamp", "available_bikes", SOURCE_INGEST_TS),
    }
    parts = [df.select(F.lit(layer).alias("layer"), F.col("station_id").cast("string").alias("station_id"), F.col(at).alias("at"),
                       F.col(bikes).alias("bikes"), F.col(seen).alias("landed"))
             for layer, (df, at, bikes, seen) in layers.items()]
    return shown(parts[0].unionByName(parts[1]).unionByName(parts[2]))


QUERIES = {"stream_pipeline": stream_pipeline, "stream_upsert": stream_upsert, "stream_scd2": stream_scd2}
ORACLES = {
    "stream_upsert": STATION_ORACLES["feed_status_merge"],
    "stream_scd2": SCD_ORACLES["scd2_fold"],
    "stream_pipeline": f"""
WITH {STATIONS_SQL},
layers AS (
  SELECT 'raw' AS layer, station_id, last_updated, num_bikes_available, ingest_ts FROM status_b
  UNION ALL SELECT 'clean', station_id, last_updated, num_bikes_available, ingest_ts FROM status_b_clean
  UNION ALL SELECT 'fact', station_id, last_updated, num_bikes_available, ingest_ts FROM status_b_clean)
SELECT layer, CAST(station_id AS VARCHAR) AS station_id, {sql_ts('last_updated')} AS "at", num_bikes_available AS bikes,
       {sql_ts(third_sql('ingest_ts'))} AS landed FROM layers""",
}
