"""Paged records, station feeds and generators.  The documents are landed first, from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.plans.ingestion import (
    CLEAN_STATUS_A, RAW_STATUS_A, STATUS_A_SOURCE, clean_info_b, clean_status_a, clean_status_b, info_a_source, info_b_source,
    status_a_pipeline, status_a_source, status_b_source,
)
from stratamart.plans.runs import read_audit, read_quarantine, read_table, run_pipeline
from stratamart.registry.inputs import (
    EVENTS_SQL, LATE, LOADED_AT, STATIONS_SQL, info_a_raw, info_b_raw, shown, sql_ts, status_a_raw, status_b_raw, table,
)
from stratamart.sources.feeds import malformed_documents, page_of, paged_records
from stratamart.sources.generators import (
    CITIES, INCREMENT, MODULUS, MULTIPLIER, PRODUCT_CATEGORIES, PRODUCT_NAMES, STATES, STORE_CITIES, STORE_STATES,
    contact_rows, sales_rows,
)
from stratamart.sources.tables import scratch_dir
from stratamart.spec import INGEST_TS

PAGE = 100
PART = T.StructType().add("p_partkey", "long").add("p_name", "string").add("p_size", "integer").add(
    "p_retailprice", "double")


def _land_pages(rows: DataFrame, number, path: str, poll: list[str] | None = None) -> str:
    """Write rows as page documents of at most PAGE records; ``number`` is a row number, unique within a poll."""
    record = [c for c in rows.columns if c not in (poll or [])]
    page = rows.withColumn("page", F.floor(number / PAGE)).groupBy(*(poll or []), "page").agg(
        F.collect_list(F.struct(*record)).alias("results"))
    page.select("results").write.json(path)
    return path


def landed_parts(spark: SparkSession, sf_dir: str) -> str:
    parts = table(spark, sf_dir, "part").select(*PART.names)
    return _land_pages(parts, F.col("p_partkey"), scratch_dir(spark))


def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, filtered and projected by the caller's expressions."""
    return paged_records(spark, landed_parts(spark, sf_dir), PART, where="p_size >= 25 and p_name is not null",
                         select=["p_partkey", "upper(p_name) as p_name", "p_size"], order_by=["p_size desc", "p_partkey"])


def page_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page of the most expensive orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page_of(orders, [F.desc("o_totalprice"), "o_orderkey"], 2 * PAGE, PAGE)


def page_offset_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page in the middle of all orders, found through the sizes of ranges of the order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return page_of(orders, [F.desc("o_totalprice"), "o_orderkey"], orders.count() // 2, PAGE, deep=PAGE)


def malformed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth page is cut short: it is quarantined, and its records are missing from the result."""
    path = scratch_dir(spark)
    parts = table(spark, sf_dir, "part").select(*PART.names)
    page = parts.withColumn("page", F.floor(F.col("p_partkey") / PAGE)).groupBy("page").agg(
        F.collect_list(F.struct(*parts.columns)).alias("results"))
    text = F.to_json(F.struct("results"))
    text = F.when(F.col("page") % 10 == 3, F.substring(text, 1, 60)).otherwise(text)
    page.select(text.alias("value")).write.text(path)
    good = paged_records(spark, path, PART).agg(F.count(F.lit(1)).alias("rows"), F.sum("p_partkey").alias("keys"))
    bad = malformed_documents(spark, path, PART).agg(F.count(F.lit(1)).alias("rows"), F.lit(None).cast("bigint")
                                                     .alias("keys"))
    return good.select(F.lit("records").alias("kind"), "rows", "keys").unionByName(
        bad.select(F.lit("quarantined").alias("kind"), "rows", "keys"))


def paged_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station attributes of source A, read from pages: the struct of coordinates survives the round trip."""
    path = _land_pages(info_a_raw(spark, sf_dir), F.col("stationcode").cast("bigint"), scratch_dir(spark), [INGEST_TS])
    return info_a_source(spark, path).select("stationcode", "name", "capacity", "coordonnees_geo.lon",
                                             "coordonnees_geo.lat", "station_opening_hours")


def paged_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station states of source A, read from pages and cleaned; malformed due dates stay text here."""
    rows = status_a_raw(spark, sf_dir, ["event_id"])
    path = _land_pages(rows.select(*STATUS_A_SOURCE.names, "event_id"), F.col("event_id"), scratch_dir(spark))
    records = paged_records(spark, path, STATUS_A_SOURCE, where="stationcode is not null")
    return shown(clean_status_a(records).select("stationcode", "timestamp", "is_installed", "numbikesavailable",
                                                "duedate", "longitude"))


def _polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a poll of source A: all states, some without key and some with a number that is none."""
    rows = status_a_raw(spark, sf_dir, ["event_id"])
    docks = F.when(F.col("event_id") % 37 == 0, "n/a").otherwise(F.col("numdocksavailable").cast("string"))
    return rows.withColumn("numdocksavailable", docks).select(*[c for c in STATUS_A_SOURCE.names if c != "timestamp"], "event_id")


def poll_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station states of source A as one poll gives them, all with the time of the call."""
    path = _land_pages(_polled(spark, sf_dir), F.col("event_id"), scratch_dir(spark))
    return shown(status_a_source(spark, path, LOADED_AT).select("stationcode", "timestamp", "numdocksavailable", "is_renting", "duedate"))


def quarantined_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A poll through its pipeline: pages that are cut short, numbers that are none and missing keys end in quarantine."""
    path, root = scratch_dir(spark), scratch_dir(spark)
    polled = _polled(spark, sf_dir)
    page = polled.withColumn("page", F.floor(F.col("event_id") / PAGE)).groupBy("page").agg(
        F.collect_list(F.struct(*[c for c in polled.columns if c != "event_id"])).alias("results"))
    text = F.to_json(F.struct("results"))
    page.select(F.when(F.col("page") % 10 == 3, F.substring(text, 1, 60)).otherwise(text).alias("value")).write.text(path)
    run_pipeline(spark, status_a_pipeline(lambda s: status_a_source(s, path, LOADED_AT, errors=True)), root, 0, LOADED_AT)
    bad = read_quarantine(spark, root).groupBy("column", "reason", "rejected").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.when(F.col("column") != "", F.col("value"))).alias("value"))
    layers = [read_table(spark, spec, root).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(spec.layer).alias("column"), F.lit("rows").alias("reason"), F.lit(False).alias("rejected"), "rows",
        F.lit(None).cast("string").alias("value")) for spec in (RAW_STATUS_A, CLEAN_STATUS_A)]
    left = read_audit(spark, root).where("layer = 'bronze'").select(
        F.lit("audit").alias("column"), F.lit("rows_rejected").alias("reason"), F.lit(True).alias("rejected"),
        F.col("rows_rejected").alias("rows"), F.lit(None).cast("string").alias("value"))
    return bad.unionByName(layers[0]).unionByName(layers[1]).unionByName(left)


def _land_feed(rows: DataFrame, number: str, updated: str, fields: list, path: str) -> str:
    """Write rows as feed documents of one poll and at most PAGE stations; ``number`` is unique within a poll."""
    documents = rows.withColumn("block", F.floor(F.col(number) / PAGE)).groupBy(updated, "block").agg(
        F.collect_list(F.struct(*fields)).alias("stations"))
    documents.select(F.col(updated).cast("string").alias("last_updated"), F.struct("stations").alias("data")).write.json(
        path)
    return path


def feed_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed documents with quoted numbers and a missing list, read and cleaned."""
    rows = info_b_raw(spark, sf_dir)
    text = [F.col(c).cast("string").alias(c) for c in ("station_id", "lat", "lon", "capacity")]
    methods = F.when(F.col("rental_methods") != "", F.split("rental_methods", ",")).alias("rental_methods")
    path = _land_feed(rows, "station_id", "last_updated", [*text, "name", "address", methods], scratch_dir(spark))
    return shown(clean_info_b(info_b_source(spark, path)))


def feed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of source B from feed documents: one document per poll of the day and block of stations."""
    rows = status_b_raw(spark, sf_dir, ["event_id"]).drop(INGEST_TS)
    fields = [c for c in rows.columns if c not in ("last_updated", "event_id")]
    path = _land_feed(rows, "event_id", "last_updated", fields, scratch_dir(spark))
    return shown(clean_status_b(status_b_source(spark, path)))


def gen_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated sales line per order."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))
    return shown(sales_rows(ids, 3, LATE, seed=7))


def gen_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated contact per customer."""
    return shown(contact_rows(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), LOADED_AT))


QUERIES = {
    "paged_records": paged,
    "page_offset": page_offset,
    "page_offset_deep": page_offset_deep,
    "malformed_pages": malformed_pages,
    "paged_stations": paged_stations,
    "paged_states": paged_states,
    "poll_states": poll_states,
    "quarantined_states": quarantined_states,
    "feed_info": feed_info,
    "feed_status": feed_status,
    "gen_sales": gen_sales,
    "gen_contacts": gen_contacts,
}


def _draw_sql(salt: int, sides: int, seed: int = 7) -> str:
    s = seed + salt
    mixed = f"((o_orderkey + {s}) % {MODULUS} * {MULTIPLIER} + {INCREMENT} + {s}) % {MODULUS}"
    return f"(({mixed}) // 65536 % {sides})"


def _case_sql(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " ELSE 'Unknown' END"


def _pick_sql(values: tuple[str, ...]) -> str:
    return f"[{', '.join(repr(v) for v in values)}][CAST(c_custkey % {len(values)} + 1 AS INTEGER)]"


ORACLES = {
    "paged_records": """
SELECT p_partkey, upper(p_name) AS p_name, p_size FROM part WHERE p_size >= 25 AND p_name IS NOT NULL""",
    "page_offset": """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 200""",
    "page_offset_deep": """
SELECT o_orderkey, o_totalprice FROM (
  SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n, count(*) OVER () // 2 AS middle
  FROM orders) WHERE n > middle AND n <= middle + 100""",
    "malformed_pages": """
SELECT 'records' AS kind, count(*) AS rows, CAST(sum(p_partkey) AS BIGINT) AS keys FROM part
WHERE p_partkey // 100 % 10 <> 3
UNION ALL
SELECT 'quarantined', count(DISTINCT p_partkey // 100), NULL FROM part WHERE p_partkey // 100 % 10 = 3""",
    "paged_stations": f"""
WITH {STATIONS_SQL}
SELECT stationcode, name, CAST(capacity AS INTEGER) AS capacity, longitude AS lon, latitude AS lat,
       station_opening_hours
FROM info_a""",
    "paged_states": f"""
WITH {STATIONS_SQL}
SELECT stationcode, {sql_ts('''date_trunc('millisecond', "timestamp")''')} AS "timestamp", is_installed,
       numbikesavailable, duedate, longitude
FROM status_a WHERE stationcode IS NOT NULL""",
    "poll_states": f"""
WITH {STATIONS_SQL}
SELECT stationcode, '2024-06-01 00:00:00.000000' AS "timestamp",
       CASE WHEN event_id % 37 <> 0 THEN numdocksavailable END AS numdocksavailable,
       CASE WHEN is_renting THEN 'OUI' WHEN NOT is_renting THEN 'NON' END AS is_renting, duedate
FROM (SELECT a.*, e.event_id FROM (SELECT *, row_number() OVER () AS n FROM status_a) a
      JOIN (SELECT event_id, row_number() OVER () AS n FROM ev WHERE is_a) e USING (n)) WHERE stationcode IS NOT NULL""",
    "quarantined_states": f"""
WITH {EVENTS_SQL},
polled AS (SELECT *, event_id // 100 % 10 = 3 AS broken, event_id % 101 = 0 AS keyless FROM ev WHERE is_a)
SELECT '' AS "column", 'malformed document' AS reason, true AS rejected, count(DISTINCT event_id // 100) AS rows,
       CAST(NULL AS VARCHAR) AS value FROM polled WHERE broken
UNION ALL SELECT 'stationcode', 'missing key', true, count(*), NULL FROM polled WHERE NOT broken AND keyless
UNION ALL SELECT 'numdocksavailable', 'does not fit int', false, count(*), 'n/a' FROM polled WHERE NOT broken AND event_id % 37 = 0
UNION ALL SELECT 'bronze', 'rows', false, count(*), NULL FROM polled WHERE NOT broken AND NOT keyless
UNION ALL SELECT 'silver', 'rows', false, count(DISTINCT user_id), NULL FROM polled WHERE NOT broken AND NOT keyless
UNION ALL SELECT 'audit', 'rows_rejected', true,
                 count(DISTINCT event_id // 100) FILTER (broken) + count(*) FILTER (NOT broken AND keyless), NULL FROM polled""",
    "feed_info": f"""
WITH {STATIONS_SQL}
SELECT station_id, name, lat, lon, address, rental_methods, CAST(capacity AS INTEGER) AS capacity,
       {sql_ts('last_updated')} AS last_updated
FROM info_b""",
    "feed_status": f"""
WITH {STATIONS_SQL}
SELECT * EXCLUDE (event_id, ingest_ts) REPLACE ({sql_ts('last_updated')} AS last_updated,
       {sql_ts('last_reported')} AS last_reported)
FROM status_b WHERE event_id % 97 <> 0""",
    "gen_sales": f"""
WITH drawn AS (
  SELECT o_orderkey AS order_id, 'PROD' || ({_draw_sql(3, 5)} + 1) AS product_id,
         'STORE' || ({_draw_sql(4, 3)} + 1) AS store_id, {_draw_sql(2, 10)} + 1 AS customer, {_draw_sql(8, 4)} AS promo,
         {_draw_sql(1, 90)} AS days, {_draw_sql(5, 5)} + 1 AS quantity, {_draw_sql(6, 90001)} + 10000 AS price,
         {_draw_sql(7, 3001)} AS discount, {_draw_sql(9, 50001)} + 5000 AS cost
  FROM orders)
SELECT order_id, CAST(3 AS INTEGER) AS order_line,
       strftime(DATE '2001-01-01' - CAST(days AS INTEGER), '%Y-%m-%d') AS order_date, 'CUST' || customer AS customer_id,
       'Customer ' || customer || ' 3' AS customer_name, product_id,
       {_case_sql('product_id', PRODUCT_NAMES)} AS product_name,
       {_case_sql('product_id', PRODUCT_CATEGORIES)} AS category,
       CASE WHEN product_id IN ('PROD1', 'PROD2') THEN 'BrandA 3' WHEN product_id = 'PROD3' THEN 'BrandB'
            ELSE 'BrandC' END AS brand,
       store_id,
       CASE store_id WHEN 'STORE1' THEN 'New York Outlet 3' WHEN 'STORE2' THEN 'Chicago Branch' ELSE 'SF Flagship' END
         AS store_name,
       {_case_sql('store_id', STORE_CITIES)} AS city, {_case_sql('store_id', STORE_STATES)} AS state,
       CAST(quantity AS INTEGER) AS quantity, CAST(CAST(price AS DECIMAL(12,0)) / 100 AS DOUBLE) AS unit_price,
       CAST(CAST(discount AS DECIMAL(12,0)) / 100 AS DOUBLE) AS discount,
       CAST(CAST(cost AS DECIMAL(12,0)) / 100 AS DOUBLE) AS cost,
       CASE promo WHEN 0 THEN 'OFFER3' WHEN 1 THEN 'BLACKFRIDAY' WHEN 2 THEN 'SUMMERSALE' END AS promo_code
FROM drawn""",
    "gen_contacts": f"""
SELECT CAST(c_custkey AS VARCHAR) AS contact_id, 'CUST' || (c_custkey + 1) AS customer_id,
       'FirstName' || c_custkey AS first_name, 'LastName' || c_custkey AS last_name,
       'contact' || c_custkey || '@example.com' AS email, '+1-555-01' || printf('%02d', c_custkey + 1) AS phone,
       'Address ' || c_custkey AS address, {_pick_sql(CITIES)} AS city, {_pick_sql(STATES)} AS state,
       '100' || printf('%02d', c_custkey + 1) AS zip_code, 'USA' AS country,
       CASE c_custkey % 2 WHEN 0 THEN 'Manager' ELSE 'Sales Rep' END AS job_title,
       '2024-06-01 00:00:00.000000' AS created_at, '2024-06-01 00:00:00.000000' AS updated_at
FROM customer""",
}
