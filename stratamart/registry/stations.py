"""Station sources: flag and epoch cleaning, keyed status merges, station attributes with history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.operators.conform import decode_flags, drop_null_keys, flatten_struct, not_before
from stratamart.functions.scalars import epoch_timestamp, utc_literal
from stratamart.plans.ingestion import (
    CLEAN_INFO_A, CLEAN_INFO_B, CLEAN_STATUS_A, CLEAN_STATUS_B, FLAGS, GEO_COLUMNS, STATUS_A, STATUS_B, clean_info_a,
    clean_info_b, clean_status_a, clean_status_b, info_a_pipeline, status_b_pipeline,
)
from stratamart.plans.runs import read_table, run_pipeline
from stratamart.registry.inputs import (
    STATIONS_SQL, ids, info_a_raw, info_b_raw, scd2_sql, shown, sql_ts, status_a_raw, status_b_raw,
)
from stratamart.sources.tables import PartitionedTable, Scd2Table, scratch_dir, staged
from stratamart.spec import INGEST_TS, TableSpec, with_ingest_ts


def flag_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags of both sources as booleans; NULL stays NULL."""
    a = decode_flags(status_a_raw(spark, sf_dir), FLAGS, "OUI").select(F.lit("a").alias("source"), *FLAGS)
    b = decode_flags(status_b_raw(spark, sf_dir), FLAGS, 1).select(F.lit("b").alias("source"), *FLAGS)
    return a.unionByName(b).groupBy("source", *FLAGS).agg(F.count(F.lit(1)).alias("rows"))


def epoch_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds as timestamps, without missing and implausible ones."""
    rows = status_b_raw(spark, sf_dir).select("station_id", "num_bikes_available", *[
        epoch_timestamp(F.col(c)).alias(c) for c in ("last_updated", "last_reported")])
    return shown(not_before(rows, ["last_updated", "last_reported"]))


def clean_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a station code, their coordinates lifted out of the struct."""
    rows = drop_null_keys(status_a_raw(spark, sf_dir), ["stationcode"])
    rows = flatten_struct(rows, "coordonnees_geo", GEO_COLUMNS)
    return shown(rows.select("stationcode", "timestamp", "longitude", "latitude"))


def _days(df: DataFrame, first: int, last: int) -> DataFrame:
    return df.filter(F.dayofmonth(INGEST_TS).between(first, last))


def _merged_status(spark: SparkSession, raw: DataFrame, spec: TableSpec, clean, day_of: str) -> DataFrame:
    """Three overlapping loads into a table partitioned by day; the day follows from the key."""
    declared = with_ingest_ts(STATUS_A if spec is CLEAN_STATUS_A else STATUS_B)
    table = PartitionedTable(spark, scratch_dir(spark), ["day"], declared.add("day", "date"), follows_key=True)
    raw = staged(raw)
    for first, last in ((1, 12), (10, 20), (18, 31)):
        rows = clean(_days(raw, first, last)).withColumn("day", F.to_date(day_of))
        table.merge(rows, list(spec.primary_key), version=INGEST_TS)
    return shown(table.read().drop("day"))


def status_merge_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_status(spark, status_a_raw(spark, sf_dir), CLEAN_STATUS_A, clean_status_a, "timestamp")


def status_merge_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_status(spark, status_b_raw(spark, sf_dir), CLEAN_STATUS_B, clean_status_b, "last_updated")


def _history(spark: SparkSession, raw: DataFrame, spec: TableSpec, clean) -> DataFrame:
    raw, table = staged(raw), Scd2Table(spark, scratch_dir(spark))
    for number, at in enumerate(ids(raw, INGEST_TS)):
        week = clean(raw.filter(F.col(INGEST_TS) == utc_literal(at)))
        table.apply(week, list(spec.primary_key), spec.change_columns, number, at)
    return shown(table.history())


def info_history_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, info_a_raw(spark, sf_dir), CLEAN_INFO_A, clean_info_a)


def info_history_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, info_b_raw(spark, sf_dir), CLEAN_INFO_B, clean_info_b)


def ingest_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of source A, week by week, and states of source B, in two halves, through their pipelines."""
    info, status, root = staged(info_a_raw(spark, sf_dir)), staged(status_b_raw(spark, sf_dir)), scratch_dir(spark)
    weeks = ids(info, INGEST_TS)
    for number, at in enumerate(weeks):
        week = F.col(INGEST_TS) == utc_literal(at)
        run_pipeline(spark, info_a_pipeline(lambda _, w=week: info.filter(w).drop(INGEST_TS)), root, number, at, stored=True)
    middle = weeks[len(weeks) // 2]
    for number, half in enumerate((F.col(INGEST_TS) < utc_literal(middle), F.col(INGEST_TS) >= utc_literal(middle))):
        run_pipeline(spark, status_b_pipeline(lambda _, h=half: status.filter(h).drop(INGEST_TS)), root, number,
                     (weeks[0], middle)[number], stored=True)
    versions = read_table(spark, CLEAN_INFO_A, root).select(
        F.lit("info_a").alias("table_name"), F.col("stationcode").alias("station_id"), F.col("capacity").alias("n"),
        F.col("scd_start_ts").alias("since"))
    states = read_table(spark, CLEAN_STATUS_B, root).select(
        F.lit("status_b").alias("table_name"), F.col("station_id").cast("string").alias("station_id"),
        F.col("num_bikes_available").alias("n"), F.col("last_updated").alias("since"))
    return shown(versions.unionByName(states))


QUERIES = {
    "flag_decode": flag_decode,
    "epoch_sanity": epoch_sanity,
    "clean_keys": clean_keys,
    "station_status_merge": status_merge_a,
    "feed_status_merge": status_merge_b,
    "station_info_scd2": info_history_a,
    "feed_info_scd2": info_history_b,
    "ingest_stations": ingest_stations,
}

_A_HISTORY = scd2_sql("info_a", "stationcode", ["name", "capacity", "longitude", "latitude", "station_opening_hours"],
                      ["stationcode", "name", "capacity", "station_opening_hours", "longitude", "latitude", "ingest_ts"])
_B_HISTORY = scd2_sql("info_b", "station_id", ["name", "lat", "lon", "address", "rental_methods", "capacity"],
                      ["station_id", "name", "lat", "lon", "address", "rental_methods", "capacity", "last_updated",
                       "ingest_ts"])
_SCD = f"""{sql_ts('scd_start_ts')} AS scd_start_ts, {sql_ts('scd_end_ts')} AS scd_end_ts,
       scd_end_ts IS NULL AS scd_is_current"""

ORACLES = {
    "flag_decode": f"""
WITH {STATIONS_SQL}
SELECT 'a' AS source, is_installed, is_renting, is_returning, count(*) AS rows FROM status_a GROUP BY ALL
UNION ALL
SELECT 'b', is_installed, is_renting, is_returning, count(*) FROM status_b GROUP BY ALL""",
    "epoch_sanity": f"""
WITH {STATIONS_SQL}
SELECT station_id, num_bikes_available, {sql_ts('last_updated')} AS last_updated,
       {sql_ts('last_reported')} AS last_reported
FROM status_b WHERE event_id % 97 <> 0""",
    "clean_keys": f"""
WITH {STATIONS_SQL}
SELECT stationcode, {sql_ts('"timestamp"')} AS "timestamp", longitude, latitude FROM status_a
WHERE stationcode IS NOT NULL""",
    "station_status_merge": f"""
WITH {STATIONS_SQL}
SELECT * REPLACE ({sql_ts('"timestamp"')} AS "timestamp", {sql_ts('ingest_ts')} AS ingest_ts) FROM status_a_clean""",
    "feed_status_merge": f"""
WITH {STATIONS_SQL}
SELECT * REPLACE ({sql_ts('last_updated')} AS last_updated, {sql_ts('last_reported')} AS last_reported,
                  {sql_ts('ingest_ts')} AS ingest_ts) FROM status_b_clean""",
    "station_info_scd2": f"""
WITH {STATIONS_SQL}
SELECT * EXCLUDE (scd_start_ts, scd_end_ts) REPLACE ({sql_ts('ingest_ts')} AS ingest_ts), {_SCD} FROM ({_A_HISTORY})""",
    "feed_info_scd2": f"""
WITH {STATIONS_SQL}
SELECT * EXCLUDE (scd_start_ts, scd_end_ts) REPLACE ({sql_ts('ingest_ts')} AS ingest_ts,
       {sql_ts('last_updated')} AS last_updated), {_SCD} FROM ({_B_HISTORY})""",
    "ingest_stations": f"""
WITH {STATIONS_SQL}
SELECT 'info_a' AS table_name, stationcode AS station_id, CAST(capacity AS INTEGER) AS n,
       {sql_ts('scd_start_ts')} AS since FROM ({_A_HISTORY})
UNION ALL
SELECT 'status_b', CAST(station_id AS VARCHAR), num_bikes_available, {sql_ts('last_updated')}
FROM status_b_clean""",
}
