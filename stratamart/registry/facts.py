"""Sales and station-status facts, watermark loads, key lookup and star queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.scalars import utc_literal
from stratamart.functions.keys import UNKNOWN_KEY
from stratamart.operators.conform import current_only
from stratamart.operators.latest import (
    incremental, latest_per_key, next_sequence, stored_watermarks, watermarks,
)
from stratamart.operators.lookup import conformed_union, key_lookup, star_join
from stratamart.operators.merge import prepared
from stratamart.operators.scd2 import rebuild_scd2
from stratamart.plans.dimensions import (
    DIM_PRODUCT, SOURCE_A, SOURCE_B, calendar_of, sales_dimension, station_dimension,
)
from stratamart.plans.facts import FACT_BIKE_STATUS, FACT_SALES, sales_fact, status_fact, status_sources
from stratamart.plans.ingestion import (
    CLEAN_SALES, clean_info_a, clean_info_b, clean_status_a, clean_status_b, status_a_pipeline, status_b_pipeline,
)
from stratamart.plans.loads import load_sales_dimension, load_sales_fact, load_status_fact
from stratamart.plans.runs import read_table, run_pipeline, save
from stratamart.registry.inputs import (
    EARLY, LATE, LOADED_AT, SALES_SQL, STATIONS_SQL, THIRDS, info_a_raw, info_b_raw, sales_source, shown, sql_key, sql_ts,
    status_a_raw, status_b_raw, table, third_of, third_sql, two_steps_sql,
)
from stratamart.sources.files import delete_path
from stratamart.sources.tables import PartitionedTable, scratch_dir, staged
from stratamart.spec import INGEST_TS, SCD_CURRENT, SOURCE_INGEST_TS

# The first load of the status fact had seen source A until the 15th and source B until the 10th.
SEEN_A, SEEN_B = datetime(2024, 1, 15), datetime(2024, 1, 10)
SOURCES = (SOURCE_A, SOURCE_B)
# The year that comes late.
MISSED_YEAR = 1995


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(sales_fact(sales_source(spark, sf_dir), LOADED_AT, key_of="content"))


def clean_statuses(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = prepared(clean_status_a(status_a_raw(spark, sf_dir)), ["stationcode", "timestamp"], [INGEST_TS])
    b = prepared(clean_status_b(status_b_raw(spark, sf_dir)), ["station_id", "last_updated"], [INGEST_TS])
    return a, b


def _seen(df: DataFrame, until: datetime) -> DataFrame:
    return df.filter(F.col(INGEST_TS) <= utc_literal(until))


def fact_bike_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads: everything up to the first watermarks, then only what came in later."""
    a, b = (staged(df) for df in clean_statuses(spark, sf_dir))
    fact = PartitionedTable(spark, scratch_dir(spark), FACT_BIKE_STATUS.partition_by, FACT_BIKE_STATUS.schema,
                            follows_key=True)
    key = list(FACT_BIKE_STATUS.primary_key)
    for seen_a, seen_b in ((_seen(a, SEEN_A), _seen(b, SEEN_B)), (a, b)):
        loaded = stored_watermarks(fact.read(), "station_source", SOURCE_INGEST_TS, SOURCES)
        fact.merge(status_fact(seen_a, seen_b, LOADED_AT, loaded), key, version=FACT_BIKE_STATUS.version_column)
    return shown(fact.read())


def incremental_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of the status fact through its model; a batch of source A becomes visible after a later one was loaded."""
    # Each batch is read from the events as it lands: a copy of all of them would be one more write of every row.
    a, b, root = status_a_raw(spark, sf_dir), status_b_raw(spark, sf_dir), scratch_dir(spark)
    pipelines = {"a": (status_a_pipeline, a), "b": (status_b_pipeline, b)}
    arrivals = [[("a", 0), ("b", 0)], [("a", 2), ("b", 1)], [("a", 1), ("b", 2)]]
    for number, arrived in enumerate(arrivals):
        for source, third in arrived:
            make, rows = pipelines[source]
            batch = rows.filter(third_of(F.col(INGEST_TS)) == third).drop(INGEST_TS)
            run_pipeline(spark, make(lambda _, batch=batch: batch), root, number, THIRDS[third], stored=True)
        load_status_fact(spark, root, number, LOADED_AT + timedelta(days=number))
    return shown(read_table(spark, FACT_BIKE_STATUS, root))


def _arriving_sales(spark: SparkSession, sf_dir: str, root: str, load) -> None:
    """The cleaned sales in two batches, the second with one year that the first should have had; a load after each."""
    arriving = scratch_dir(spark)
    sales = staged(sales_source(spark, sf_dir), arriving)
    for number, at in enumerate((EARLY, LATE)):
        first = (F.col(INGEST_TS) <= utc_literal(EARLY)) & (F.year(INGEST_TS) != MISSED_YEAR)
        save(spark, CLEAN_SALES, root, sales.filter(first if number == 0 else ~first), number, at, stored=True)
        if at == LATE:
            delete_path(spark, arriving)  # all of it has arrived
        load(number, at)


def fact_sales_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact loaded twice; the second load reads the lines of new ingest batches only, older ones among them."""
    root = scratch_dir(spark)
    _arriving_sales(spark, sf_dir, root, lambda number, at: load_sales_fact(spark, root, number, at))
    return shown(read_table(spark, FACT_SALES, root))


def dim_product_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products from new ingest batches and a stored partial aggregate; what comes late does not undo newer attributes."""
    root = scratch_dir(spark)
    _arriving_sales(spark, sf_dir, root, lambda number, at: load_sales_dimension(spark, "dim_product", root, number, at))
    return shown(read_table(spark, DIM_PRODUCT, root).drop(INGEST_TS))


STATUS_FACT_SQL = f"""
{STATIONS_SQL},
statuses AS (
  SELECT 'source_a' AS station_source, stationcode AS station_id, "timestamp", numdocksavailable AS available_docks,
         numbikesavailable AS available_bikes, mechanical AS mechanical_bikes, ebike AS electric_bikes, is_installed,
         is_renting, is_returning, TRY_CAST(duedate AS TIMESTAMP) AS due_date, ingest_ts AS source_ingest_ts
  FROM status_a_clean
  UNION ALL
  SELECT 'source_b', CAST(station_id AS VARCHAR), last_updated, num_docks_available, num_bikes_available, NULL, NULL,
         is_installed, is_renting, is_returning, NULL, ingest_ts
  FROM status_b_clean)
"""


def status_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources conformed and united, as the fact takes them."""
    sources = status_sources(*clean_statuses(spark, sf_dir))
    return shown(conformed_union(sources, "station_source", ["station_source", *sources[SOURCE_A].columns]))


def high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = clean_statuses(spark, sf_dir)
    loaded = status_fact(_seen(a, SEEN_A), _seen(b, SEEN_B), LOADED_AT)
    return shown(watermarks(loaded, "station_source", SOURCE_INGEST_TS))


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows newer than what a first load stored, per source."""
    a, b = clean_statuses(spark, sf_dir)
    loaded = stored_watermarks(status_fact(_seen(a, SEEN_A), _seen(b, SEEN_B), LOADED_AT),
                               "station_source", SOURCE_INGEST_TS, SOURCES)
    fresh = incremental(status_sources(a, b), loaded, SOURCE_INGEST_TS)
    rows = [df.select(F.lit(name).alias("station_source"), "station_id", "timestamp", SOURCE_INGEST_TS)
            for name, df in fresh.items()]
    return shown(rows[0].unionByName(rows[1]))


def next_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a filled table, an empty one, and one whose numbers are text."""
    lines = table(spark, sf_dir, "lineitem").select("l_linenumber")
    contacts = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    mixed = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise(F.col("c_name"))
    found = {
        "filled": next_sequence(lines, "l_linenumber"),
        "empty": next_sequence(lines.filter(F.col("l_linenumber") < 0), "l_linenumber"),
        "text": next_sequence(contacts, mixed),
    }
    rows = [df.select(F.lit(name).alias("target"), "next_value") for name, df in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def looked_up_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogate keys taken from stored dimensions; products of one brand are missing from theirs."""
    sales = staged(sales_source(spark, sf_dir))
    stores = staged(latest_per_key(sales_dimension("dim_store", sales, LOADED_AT), ["store_id"], SOURCE_INGEST_TS,
                                   unique=True))
    known = sales.filter(~F.col("brand").startswith("Brand#1"))
    products = staged(latest_per_key(sales_dimension("dim_product", known, LOADED_AT), ["product_id"],
                                     SOURCE_INGEST_TS, unique=True))
    promos = staged(sales_dimension("dim_promo", sales, LOADED_AT))
    rows = fact = sales.select("order_id", "order_line", "store_id", "product_id", "promo_code")
    # The dimension that is too large to broadcast comes first, while the rows are narrow.
    rows = key_lookup(rows, products, ["product_id"], "product_key", counted=fact)
    rows = key_lookup(rows, stores, ["store_id"], "store_key", counted=fact)
    rows = key_lookup(rows, promos, ["promo_code"], "promo_key", counted=fact)
    return rows.select("order_id", "order_line", "store_key", "product_key", "promo_key")


def star_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by product category, store region and month over the star schema."""
    sales = staged(sales_source(spark, sf_dir))
    fact = sales_fact(sales, LOADED_AT, key_of="content")
    products = staged(sales_dimension("dim_product", sales, LOADED_AT, key_of="content"))
    stores = staged(sales_dimension("dim_store", sales, LOADED_AT, key_of="content"))
    customers = staged(sales_dimension("dim_customer", sales, LOADED_AT, key_of="content"))
    promos = staged(sales_dimension("dim_promo", sales, LOADED_AT, key_of="content"))
    dates = staged(calendar_of(sales, "order_date", LOADED_AT))
    star = star_join(fact.select("product_key", "store_key", "customer_key", "promo_key", "date_key", "quantity",
                                 "total_price", "profit"), {
        "product_key": products.select("product_key", "category"),
        "store_key": stores.select("store_key", "state"),
        "customer_key": customers.select("customer_key", F.lit(1).alias("is_customer")),
        "promo_key": promos.select("promo_key", "promo_code"),
        "date_key": dates.select("date_key", "year", "month"),
    })
    totals = star.groupBy("category", "state", "promo_code", "year", "month").agg(
        F.sum("is_customer").alias("lines"), F.sum("quantity").alias("quantity"),
        F.sum("total_price").cast("decimal(18,2)").alias("total_price"),
        F.sum("profit").cast("decimal(18,2)").alias("profit"),
    )
    return shown(totals)


def current_infos(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both station tables with their history, rebuilt from the weekly batches."""
    a, b = clean_info_a(info_a_raw(spark, sf_dir)), clean_info_b(info_b_raw(spark, sf_dir))
    a, b = a.withColumn("at", F.col(INGEST_TS)), b.withColumn("at", F.col(INGEST_TS))
    return (
        rebuild_scd2(a, ["stationcode"], ["name", "capacity", "longitude", "latitude", "station_opening_hours"], "at"),
        rebuild_scd2(b, ["station_id"], ["name", "lat", "lon", "address", "rental_methods", "capacity"], "at"),
    )


def star_bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bikes by hour of the day, kind of day, source and station capacity."""
    fact = status_fact(*clean_statuses(spark, sf_dir), LOADED_AT)
    stations = staged(station_dimension(*current_infos(spark, sf_dir), LOADED_AT).withColumn(SCD_CURRENT, F.lit(True)))
    dates = staged(calendar_of(table(spark, sf_dir, "events"), "ts", LOADED_AT))
    star = star_join(fact.select("station_key", "date_key", "station_source", "timestamp", "available_bikes"), {
        "station_key": current_only(stations).select("station_key", "capacity"),
        "date_key": dates.select("date_key", "is_weekend"),
    })
    return star.groupBy("station_source", "capacity", "is_weekend", F.hour("timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("polls"), F.sum("available_bikes").alias("bikes"),
        F.max("available_bikes").alias("most_bikes"),
    )


QUERIES = {
    "fact_sales": fact_sales,
    "fact_sales_incremental": fact_sales_incremental,
    "dim_product_incremental": dim_product_incremental,
    "fact_bike_status": fact_bike_status,
    "incremental_late_rows": incremental_late_rows,
    "conformed_union": status_union,
    "high_watermark": high_watermark,
    "incremental_load": incremental_load,
    "next_sequence": next_sequences,
    "key_lookup": looked_up_keys,
    "star_sales_by_category_month": star_sales,
    "star_bikes_by_hour": star_bikes,
}

_PRODUCT = ("product_id", "product_name", "category", "brand")
_STORE = ("store_id", "store_name", "city", "state")
_SEEN = """((station_source = 'source_a' AND source_ingest_ts <= TIMESTAMP '2024-01-15')
            OR (station_source = 'source_b' AND source_ingest_ts <= TIMESTAMP '2024-01-10'))"""



def _sales_fact_sql(customer: tuple[str, ...], product: tuple[str, ...], store: tuple[str, ...], loaded: str) -> str:
    return f"""
WITH {SALES_SQL},
cents AS (SELECT *, CAST(unit_price * 100 AS BIGINT) AS pc, CAST(discount * 100 AS BIGINT) AS dc FROM sales)
SELECT {sql_key('order_id', 'order_line')} AS sales_key, strftime(order_date, '%Y%m%d') AS date_key,
       {sql_key(*customer)} AS customer_key, {sql_key(*product)} AS product_key,
       {sql_key(*store)} AS store_key,
       CASE WHEN promo_code IS NULL THEN '{UNKNOWN_KEY}' ELSE {sql_key('promo_code')} END AS promo_key,
       order_id, order_line, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, CAST(cost AS DOUBLE) AS cost,
       CAST(quantity * unit_price AS DOUBLE) AS total_price,
       CAST(CAST(((20000 * dc + pc) // nullif(2 * pc, 0)) AS DECIMAL(18,0)) / 100 AS DOUBLE) AS discount_pct,
       CAST(quantity * unit_price - cost AS DOUBLE) AS profit,
       {loaded} AS ingest_ts
FROM cents"""


def _status_fact_sql(seen: str, loaded: str) -> str:
    return f"""
WITH {STATUS_FACT_SQL}
SELECT {sql_key('station_source', 'station_id')} AS station_key, strftime("timestamp", '%Y%m%d') AS date_key,
       station_source, station_id, {sql_ts('"timestamp"')} AS "timestamp", available_docks, available_bikes,
       mechanical_bikes, electric_bikes, is_installed, is_renting, is_returning, {sql_ts('due_date')} AS due_date,
       {sql_ts(seen)} AS source_ingest_ts, {loaded} AS ingest_ts
FROM statuses"""


_IN_FIRST = f"ingest_ts <= TIMESTAMP '1998-01-01' AND year(ingest_ts) <> {MISSED_YEAR}"
_THIRD = "least((day(source_ingest_ts) - 1) // 11, 2)"
_LOAD = f"CASE WHEN station_source = 'source_a' THEN [0, 2, 1][{_THIRD} + 1] ELSE {_THIRD} END"

ORACLES = {
    "fact_sales": _sales_fact_sql(("customer_id", "customer_name"), _PRODUCT, _STORE, "'2024-06-01 00:00:00.000000'"),
    "fact_sales_incremental": _sales_fact_sql(
        ("customer_id",), ("product_id",), ("store_id",),
        f"CASE WHEN {_IN_FIRST} THEN '1998-01-01 00:00:00.000000' ELSE '2001-01-01 00:00:00.000000' END"),
    "dim_product_incremental": f"WITH {SALES_SQL}, " + two_steps_sql("dim_product", early=_IN_FIRST, late="true"),
    "fact_bike_status": _status_fact_sql("source_ingest_ts", "'2024-06-01 00:00:00.000000'"),
    "incremental_late_rows": _status_fact_sql(
        third_sql("source_ingest_ts"), sql_ts(f"TIMESTAMP '2024-06-01' + to_days(CAST({_LOAD} AS INTEGER))")),
    "conformed_union": f"""
WITH {STATUS_FACT_SQL}
SELECT station_source, station_id, {sql_ts('"timestamp"')} AS "timestamp", available_docks, available_bikes,
       mechanical_bikes, electric_bikes, is_installed, is_renting, is_returning, {sql_ts('due_date')} AS due_date,
       {sql_ts('source_ingest_ts')} AS source_ingest_ts
FROM statuses""",
    "high_watermark": f"""
WITH {STATUS_FACT_SQL}
SELECT station_source, {sql_ts('max(source_ingest_ts)')} AS source_ingest_ts FROM statuses
WHERE {_SEEN} GROUP BY station_source""",
    "incremental_load": f"""
WITH {STATUS_FACT_SQL}
SELECT station_source, station_id, {sql_ts('"timestamp"')} AS "timestamp",
       {sql_ts('source_ingest_ts')} AS source_ingest_ts
FROM statuses s
WHERE source_ingest_ts > (SELECT max(source_ingest_ts) FROM statuses t
                          WHERE {_SEEN} AND t.station_source = s.station_source)""",
    "next_sequence": """
SELECT 'filled' AS target, CAST(max(l_linenumber) + 1 AS BIGINT) AS next_value FROM lineitem
UNION ALL SELECT 'empty', CAST(1 AS BIGINT)
UNION ALL SELECT 'text', CAST(max(CASE WHEN c_custkey % 2 = 0 THEN c_custkey END) + 1 AS BIGINT) FROM customer""",
    "key_lookup": f"""
WITH {SALES_SQL},
known AS (SELECT DISTINCT product_id FROM sales WHERE brand NOT LIKE 'Brand#1%')
SELECT order_id, order_line, {sql_key('store_id')} AS store_key,
       CASE WHEN product_id IN (SELECT product_id FROM known) THEN {sql_key('product_id')}
            ELSE '{UNKNOWN_KEY}' END AS product_key,
       CASE WHEN promo_code IS NULL THEN '{UNKNOWN_KEY}' ELSE {sql_key('promo_code')} END AS promo_key
FROM sales""",
    "star_sales_by_category_month": f"""
WITH {SALES_SQL}
SELECT category, state, coalesce(promo_code, 'unknown') AS promo_code, CAST(year(order_date) AS INTEGER) AS year,
       CAST(month(order_date) AS INTEGER) AS month, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(quantity * unit_price) AS DOUBLE) AS total_price,
       CAST(sum(quantity * unit_price - cost) AS DOUBLE) AS profit
FROM sales GROUP BY ALL""",
    "star_bikes_by_hour": f"""
WITH {STATUS_FACT_SQL},
stations AS (
  SELECT 'source_a' AS station_source, stationcode AS station_id, arg_max(capacity, ingest_ts) AS capacity
  FROM info_a GROUP BY stationcode
  UNION ALL
  SELECT 'source_b', CAST(station_id AS VARCHAR), arg_max(capacity, ingest_ts) FROM info_b GROUP BY station_id)
SELECT s.station_source, CAST(capacity AS INTEGER) AS capacity, dayofweek("timestamp") IN (0, 6) AS is_weekend,
       CAST(hour("timestamp") AS INTEGER) AS hour, count(*) AS polls, CAST(sum(available_bikes) AS BIGINT) AS bikes,
       max(available_bikes) AS most_bikes
FROM statuses s JOIN stations USING (station_source, station_id) GROUP BY ALL""",
}
