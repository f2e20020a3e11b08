"""What runs leave behind: stored audit rows, and models merged over several runs."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.scalars import utc_literal
from stratamart.operators.scd2 import rebuild_scd2
from stratamart.plans.dimensions import DATE_MODEL, DIM_BIKE_STATION, DIM_DATE, STATION_MODEL
from stratamart.plans.ingestion import CLEAN_INFO_A, CLEAN_INFO_B, clean_info_a, clean_info_b, contacts_pipeline, info_a_pipeline
from stratamart.plans.runs import read_audit, read_table, run_model, run_pipeline
from stratamart.registry.inputs import (
    CONTACTS_SQL, EARLY, LATE, STATIONS_SQL, THIRDS, contacts_source, ids, info_a_raw, info_b_raw, scd2_sql, shown, sql_key,
    sql_ts, table,
)
from stratamart.sources.tables import scratch_dir, staged
from stratamart.spec import AUDIT_COUNTS, INGEST_TS, SOURCE_INGEST_TS

MIDDLE = datetime(2024, 1, 15)
# The two runs of the date dimension overlap.
FIRST_DAYS, MORE_DAYS = (date(1992, 1, 1), date(1996, 6, 30)), (date(1995, 1, 1), date(1998, 12, 31))


def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit rows that runs of two pipelines stored: contacts, some without key and some deleted, and station versions."""
    contacts, root = contacts_source(spark, sf_dir), scratch_dir(spark)
    run_pipeline(spark, contacts_pipeline(lambda _: contacts.filter(~F.col("contact_id").endswith("7"))), root, 0, EARLY)
    keyless = contacts.filter(F.col("contact_id").startswith("A")).withColumn(
        "contact_id", F.when(~F.col("contact_id").endswith("9"), F.col("contact_id")))
    gone = contacts.filter(F.col("city") == "NATION_3").select("contact_id")
    for _ in range(2):  # a repeated run replaces its rows
        run_pipeline(spark, replace(contacts_pipeline(lambda _: keyless), deletes=lambda _: gone), root, 1, LATE)
    info = staged(info_a_raw(spark, sf_dir))
    for number, at in enumerate(ids(info, INGEST_TS)):
        week = info.filter(F.col(INGEST_TS) == utc_literal(at)).drop(INGEST_TS)
        run_pipeline(spark, info_a_pipeline(lambda _, week=week: week), root, number, at)
    return shown(read_audit(spark, root))


def dim_bike_station_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations as two runs of their model leave them: as known in the middle of the time, and at its end."""
    root = scratch_dir(spark)
    a = staged(clean_info_a(info_a_raw(spark, sf_dir)).withColumn("at", F.col(INGEST_TS)))
    b = staged(clean_info_b(info_b_raw(spark, sf_dir)).withColumn("at", F.col(INGEST_TS)))
    for number, known in enumerate((F.col("at") <= utc_literal(MIDDLE), F.lit(True))):
        infos = {"info_a": rebuild_scd2(a.filter(known), ["stationcode"], CLEAN_INFO_A.change_columns, "at"),
                 "info_b": rebuild_scd2(b.filter(known), ["station_id"], CLEAN_INFO_B.change_columns, "at")}
        run_model(spark, STATION_MODEL, root, number, THIRDS[number], **infos)
    return shown(read_table(spark, DIM_BIKE_STATION, root).drop(INGEST_TS))


def dim_date_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date dimension over two overlapping runs, with the number of orders of each day."""
    root = scratch_dir(spark)
    for number, (first, last) in enumerate((FIRST_DAYS, MORE_DAYS)):
        run_model(spark, DATE_MODEL, root, number, THIRDS[number], spark=spark, start=first, end=last)
    orders = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("date_key")).agg(
        F.count(F.lit(1)).alias("orders"))
    days = read_table(spark, DIM_DATE, root).join(orders, "date_key", "left")
    return shown(days.select("date_key", "date", "week", "day_of_week", "is_weekend", F.coalesce("orders", F.lit(0)).alias("orders"),
                             INGEST_TS))


QUERIES = {"run_audit": run_audit, "dim_bike_station_runs": dim_bike_station_runs, "dim_date_runs": dim_date_runs}


def _counts(**known: str) -> str:
    return ", ".join(f"CAST({known.get(c.removeprefix('rows_'), 'NULL')} AS BIGINT) AS {c}" for c in AUDIT_COUNTS)


def _stations(seen: str) -> str:
    a = scd2_sql(f"(SELECT * FROM info_a WHERE {seen})", "stationcode",
                 ["name", "capacity", "longitude", "latitude", "station_opening_hours"], ["*"])
    b = scd2_sql(f"(SELECT * FROM info_b WHERE {seen})", "station_id",
                 ["name", "lat", "lon", "address", "rental_methods", "capacity"], ["*"])
    return f"""
      SELECT 'source_a' AS station_source, stationcode AS station_id, lower(name) AS station_name, capacity,
             station_opening_hours, longitude, latitude, NULL AS address, ingest_ts AS source_ingest_ts
      FROM ({a}) WHERE scd_end_ts IS NULL
      UNION ALL
      SELECT 'source_b', CAST(station_id AS VARCHAR), lower(name), capacity, NULL, lon, lat, lower(address), ingest_ts
      FROM ({b}) WHERE scd_end_ts IS NULL"""


_SAME = " AND ".join(f"e.{c} IS NOT DISTINCT FROM l.{c}" for c in DIM_BIKE_STATION.change_columns)

ORACLES = {
    "run_audit": f"""
WITH {CONTACTS_SQL}, {STATIONS_SQL},
early AS (SELECT contact_id, city FROM contacts WHERE contact_id NOT LIKE '%7'),
late AS (SELECT contact_id, city FROM contacts WHERE contact_id LIKE 'A%'),
keyed AS (SELECT * FROM late WHERE contact_id NOT LIKE '%9'),
known AS (SELECT * FROM early UNION SELECT * FROM keyed),
weeks AS (
  SELECT ingest_ts, dense_rank() OVER (ORDER BY ingest_ts) - 1 AS batch_id,
         row_number() OVER station = 1 AS opens, capacity IS DISTINCT FROM lag(capacity) OVER station AS differs
  FROM info_a WINDOW station AS (PARTITION BY stationcode ORDER BY ingest_ts)),
loads AS (
  SELECT 'bronze' AS layer, 'contacts' AS table_name, 0 AS batch_id, TIMESTAMP '1998-01-01' AS loaded,
         {_counts(read='(SELECT count(*) FROM early)', insert='(SELECT count(*) FROM early)')}
  UNION ALL
  SELECT 'silver', 'contacts', 0, TIMESTAMP '1998-01-01', {_counts(
      read='(SELECT count(*) FROM early)', rejected='0', insert='(SELECT count(*) FROM early)', update='0', ignore='0')}
  UNION ALL
  SELECT 'bronze', 'contacts', 1, TIMESTAMP '2001-01-01',
         {_counts(read='(SELECT count(*) FROM late)', insert='(SELECT count(*) FROM late)')}
  UNION ALL
  SELECT 'silver', 'contacts', 1, TIMESTAMP '2001-01-01', {_counts(
      read='(SELECT count(*) FROM late)', rejected="(SELECT count(*) FROM late WHERE contact_id LIKE '%9')",
      insert="(SELECT count(*) FROM keyed WHERE contact_id LIKE '%7')",
      update="(SELECT count(*) FROM keyed WHERE contact_id NOT LIKE '%7')", ignore='0',
      delete="(SELECT count(*) FROM known WHERE city = 'NATION_3')")}
  UNION ALL
  SELECT 'bronze', 'station_info_a', batch_id, ingest_ts, {_counts(read='count(*)', rejected='0', insert='count(*)')}
  FROM weeks GROUP BY batch_id, ingest_ts
  UNION ALL
  SELECT 'silver', 'station_info_a', batch_id, ingest_ts, {_counts(
      read='count(*)', rejected='0', insert='count(*) FILTER (opens)', change='count(*) FILTER (differs AND NOT opens)',
      unchanged='count(*) FILTER (NOT differs)', close='0')}
  FROM weeks GROUP BY batch_id, ingest_ts)
SELECT * EXCLUDE (loaded) REPLACE (CAST(batch_id AS BIGINT) AS batch_id), {sql_ts('loaded')} AS ingest_ts FROM loads""",
    "dim_bike_station_runs": f"""
WITH {STATIONS_SQL},
early AS ({_stations("ingest_ts <= TIMESTAMP '2024-01-15'")}),
late AS ({_stations("true")}),
versions AS (
  SELECT e.*, TIMESTAMP '2024-03-01' AS scd_start_ts, CASE WHEN {_SAME} THEN NULL ELSE TIMESTAMP '2024-03-02' END AS scd_end_ts
  FROM early e JOIN late l USING (station_source, station_id)
  UNION ALL
  SELECT l.*, TIMESTAMP '2024-03-02', NULL FROM late l LEFT JOIN early e USING (station_source, station_id)
  WHERE e.station_id IS NULL OR NOT ({_SAME}))
SELECT * REPLACE (CAST(capacity AS INTEGER) AS capacity, {sql_ts('source_ingest_ts')} AS {SOURCE_INGEST_TS},
                  {sql_ts('scd_start_ts')} AS scd_start_ts, {sql_ts('scd_end_ts')} AS scd_end_ts),
       {sql_key('station_source', 'station_id')} AS station_key, scd_end_ts IS NULL AS scd_is_current
FROM versions""",
    "dim_date_runs": """
WITH days AS (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
counted AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)
SELECT strftime(d, '%Y%m%d') AS date_key, strftime(d, '%Y-%m-%d') AS date, CAST(week(d) AS INTEGER) AS week,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend, coalesce(orders, 0) AS orders,
       CASE WHEN d < DATE '1995-01-01' THEN '2024-03-01 00:00:00.000000' ELSE '2024-03-02 00:00:00.000000' END AS ingest_ts
FROM days LEFT JOIN counted USING (d)""",
}
