"""Dimensions, built in two steps (as of 1998, as of 2001) so that changed attributes leave a history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.keys import surrogate_key
from stratamart.functions.scalars import utc_literal
from stratamart.operators.latest import latest_per_key
from stratamart.operators.lookup import enrich_left
from stratamart.plans.dimensions import (
    CONTACT_COLUMNS, SALES_DIMENSIONS, calendar_of, customer_dimension, sales_dimension, station_dimension,
)
from stratamart.registry.facts import current_infos
from stratamart.registry.inputs import (
    CONTACTS_SQL, EARLY, LATE, LOADED_AT, SALES_SQL, STATIONS_SQL, contacts_source, sales_source, scd2_sql, shown,
    sql_key, sql_ts, table, two_steps_sql,
)
from stratamart.sources.tables import Scd2Table, scratch_dir, staged
from stratamart.spec import INGEST_TS, SOURCE_INGEST_TS


def _two_steps(spark: SparkSession, generate, key: str, change, overwrite=()) -> DataFrame:
    """Fold what ``generate`` gives as of both dates into a type 2 table."""
    dimension = Scd2Table(spark, scratch_dir(spark))
    for number, as_of in enumerate((EARLY, LATE)):
        dimension.apply(generate(as_of), [key], change, number, as_of, order_by=[SOURCE_INGEST_TS],
                        overwrite=overwrite)
    return shown(dimension.history().drop(INGEST_TS))


def _attribute_rows(spark: SparkSession, sf_dir: str, attributes) -> DataFrame:
    """The distinct attribute rows of every batch: all a dimension needs from the sales, written once."""
    return staged(sales_source(spark, sf_dir).select(*attributes, INGEST_TS).distinct())


def _as_of(sales: DataFrame, as_of) -> DataFrame:
    return sales.filter(F.col(INGEST_TS) <= utc_literal(as_of))


def _sales_dimension(name: str):
    key, attributes, _ = SALES_DIMENSIONS[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        sales = _attribute_rows(spark, sf_dir, attributes)
        return _two_steps(spark, lambda at: sales_dimension(name, _as_of(sales, at), at), key, attributes)

    return query


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contact columns arrive with the second step; they are refreshed in place, without new versions."""
    key, attributes, _ = SALES_DIMENSIONS["dim_customer"]
    sales = _attribute_rows(spark, sf_dir, attributes)
    contacts = contacts_source(spark, sf_dir)

    def generate(at):
        return customer_dimension(_as_of(sales, at), contacts if at == LATE else None, at)

    return _two_steps(spark, generate, key, attributes, CONTACT_COLUMNS)


def dim_bike_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(station_dimension(*current_infos(spark, sf_dir), LOADED_AT))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(calendar_of(table(spark, sf_dir, "orders"), "o_orderdate", LOADED_AT))


def content_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products keyed by all their attributes: a renamed brand is another member."""
    return shown(sales_dimension("dim_product", sales_source(spark, sf_dir), LOADED_AT, key_of="content"))


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of every customer's latest month, ties kept."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.date_trunc("month", "o_orderdate")
                                                   .alias("month"))
    return shown(latest_per_key(orders, ["o_custkey"], "month"))


def enriched_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their contacts; several contacts give several rows, none gives NULLs."""
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("CUST"), F.col("c_custkey").cast("string")).alias("customer_id"), "c_mktsegment")
    contacts = contacts_source(spark, sf_dir).select("customer_id", "contact_id", "email", "city", "job_title")
    return enrich_left(customers, contacts, ["customer_id"])


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys over columns with NULLs, empty text, separators and escapes in them."""
    n = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(n % 4 == 0, None).when(n % 4 == 1, "").when(n % 4 == 2, "a|b").otherwise("a\\").alias("left_part"),
        F.when(n % 3 == 0, None).when(n % 3 == 1, "\\N").otherwise("b|").alias("right_part"),
        F.date_add(F.lit("2020-01-01").cast("date"), (n % 366).cast("int")).alias("day"),
    )
    return rows.select(
        "c_custkey",
        surrogate_key(["left_part", "right_part"]).alias("text_key"),
        surrogate_key(["c_custkey", "left_part", "day"]).alias("mixed_key"),
    )


QUERIES = {
    "dim_product": _sales_dimension("dim_product"),
    "dim_store": _sales_dimension("dim_store"),
    "dim_promo": _sales_dimension("dim_promo"),
    "dim_customer": dim_customer,
    "dim_bike_station": dim_bike_station,
    "dim_date": dim_date,
    "dim_product_by_content": content_dimension,
    "latest_per_key": latest_orders,
    "enrich_left": enriched_customers,
    "surrogate_keys": surrogate_keys,
}


ORACLES = {
    "dim_product": f"WITH {SALES_SQL}, {two_steps_sql('dim_product')}",
    "dim_store": f"WITH {SALES_SQL}, {two_steps_sql('dim_store')}",
    "dim_promo": f"WITH {SALES_SQL}, {two_steps_sql('dim_promo')}",
    "dim_customer": f"""
WITH {SALES_SQL}, {CONTACTS_SQL},
newest AS (SELECT * FROM contacts QUALIFY row_number() OVER (PARTITION BY customer_id
             ORDER BY updated_at DESC, contact_id DESC) = 1),
{two_steps_sql('dim_customer', CONTACT_COLUMNS)}""",
    "dim_bike_station": f"""
WITH {STATIONS_SQL},
a AS ({scd2_sql('info_a', 'stationcode', ['name', 'capacity', 'longitude', 'latitude', 'station_opening_hours'],
                ['*'])}),
b AS ({scd2_sql('info_b', 'station_id', ['name', 'lat', 'lon', 'address', 'rental_methods', 'capacity'], ['*'])}),
stations AS (
  SELECT 'source_a' AS station_source, stationcode AS station_id, lower(name) AS station_name, capacity,
         station_opening_hours, longitude, latitude, NULL AS address, ingest_ts AS source_ingest_ts
  FROM a WHERE scd_end_ts IS NULL
  UNION ALL
  SELECT 'source_b', CAST(station_id AS VARCHAR), lower(name), capacity, NULL, lon, lat, lower(address), ingest_ts
  FROM b WHERE scd_end_ts IS NULL)
SELECT {sql_key('station_source', 'station_id')} AS station_key, station_source, station_id, station_name,
       CAST(capacity AS INTEGER) AS capacity, station_opening_hours, longitude, latitude, address,
       {sql_ts('source_ingest_ts')} AS source_ingest_ts, '2024-06-01 00:00:00.000000' AS ingest_ts
FROM stations""",
    "dim_date": """
WITH days AS (
  SELECT CAST(unnest(generate_series(CAST((SELECT min(o_orderdate) FROM orders) AS DATE),
                                     CAST((SELECT max(o_orderdate) FROM orders) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d)
SELECT strftime(d, '%Y%m%d') AS date_key, strftime(d, '%Y-%m-%d') AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(week(d) AS INTEGER) AS week,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       dayofweek(d) IN (0, 6) AS is_weekend, '2024-06-01 00:00:00.000000' AS ingest_ts
FROM days""",
    "dim_product_by_content": f"""
WITH {SALES_SQL}
SELECT {sql_key('product_id', 'product_name', 'category', 'brand')} AS product_key, product_id, product_name, category,
       brand, {sql_ts('max(ingest_ts)')} AS source_ingest_ts, '2024-06-01 00:00:00.000000' AS ingest_ts
FROM sales GROUP BY product_id, product_name, category, brand""",
    "latest_per_key": f"""
SELECT o_custkey, o_orderkey, {sql_ts("date_trunc('month', o_orderdate)")} AS month
FROM orders
QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate) DESC) = 1""",
    "enrich_left": f"""
WITH {CONTACTS_SQL}
SELECT 'CUST' || c_custkey AS customer_id, c_mktsegment, contact_id, email, city, job_title
FROM customer LEFT JOIN contacts ON contacts.customer_id = 'CUST' || c_custkey""",
    "surrogate_keys": f"""
WITH parts AS (
  SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a|b' ELSE 'a\\' END AS left_part,
         CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '\\N' ELSE 'b|' END AS right_part,
         DATE '2020-01-01' + CAST(c_custkey % 366 AS INTEGER) AS day
  FROM customer)
SELECT c_custkey, {sql_key('left_part', 'right_part')} AS text_key,
       {sql_key('c_custkey', 'left_part', 'day')} AS mixed_key
FROM parts""",
}
