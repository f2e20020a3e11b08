"""The given tables seen as the sources of the pipelines, in Spark and in SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.keys import UNKNOWN_KEY
from stratamart.functions.scalars import utc_datetime, utc_literal
from stratamart.operators.conform import conform, drop_null_keys
from stratamart.operators.dedupe import one_row_per_key
from stratamart.operators.skew import fits_broadcast, heavy_keys, needs_salting, spread_join
from stratamart.plans.dimensions import SALES_DIMENSIONS
from stratamart.plans.ingestion import (
    CONTACTS, INFO_A_SOURCE, INFO_B_SOURCE, SALES, STATUS_A_SOURCE, STATUS_B_SOURCE,
)
from stratamart.spec import INGEST_TS, with_ingest_ts

LOADED_AT = datetime(2024, 6, 1)
EARLY, LATE = datetime(1998, 1, 1), datetime(2001, 1, 1)


# The events of a month arrive in three batches, by the day of the month.
THIRDS = (datetime(2024, 3, 1), datetime(2024, 3, 2), datetime(2024, 3, 3))


def third_of(day: Column) -> Column:
    return F.least(F.floor((F.dayofmonth(day) - 1) / 11), F.lit(2)).cast("int")


def third_sql(day: str) -> str:
    """When the batch with that day's events arrives."""
    return f"TIMESTAMP '2024-03-01' + to_days(CAST(least((day({day}) - 1) // 11, 2) AS INTEGER))"


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is inferred once, and its zoneless timestamps are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_schemas[path]).parquet(path)
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def shown(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text: the form in which results are compared."""
    def one(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
        return F.col(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def sql_ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def year_start(column: str) -> Column:
    return F.date_trunc("year", F.col(column))


def ids(df: DataFrame, column: str) -> list:
    """The few distinct values of a batch column, ascending."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return sorted(utc_datetime(r[0]) for r in df.select(F.unix_micros(column)).distinct().collect())
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _with_region(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Nation and region names of ``n_nationkey``; two tables of a few rows each, joined one after the other
    so that Catalyst sees how small they are."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    return df.join(nations, "n_nationkey").join(table(spark, sf_dir, "region"), "r_regionkey")


# --- sales -----------------------------------------------------------------------------------------------

LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag"]


def sales_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales line per (order, line), with the ingest timestamp of its yearly batch.

    Some names change in 1999, so the dimensions have history.
    """
    raw = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_retailprice")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey"))

    # Hot keys of all large joins are found in one pass over the lines.
    joined = {"l_orderkey": orders, "l_partkey": parts, "l_suppkey": suppliers}
    large = {key for key, right in joined.items() if not fits_broadcast(right)}
    salted = {key: [key] for key in large if needs_salting(raw, joined[key])}
    heavy = heavy_keys(raw, salted) if salted else {}
    if "l_orderkey" in large and ("l_orderkey" not in heavy or heavy["l_orderkey"].isEmpty()):
        # One shuffle serves the choice of a row per line and the join with the orders.
        raw = drop_null_keys(raw, ["l_orderkey"]).repartition("l_orderkey")
    lines = one_row_per_key(raw, ["l_orderkey", "l_linenumber"], LINE_ORDER)

    def with_large(rows: DataFrame, key: str, right: DataFrame) -> DataFrame:
        return spread_join(rows, right, [key], heavy=heavy[key], force_salting=True) if key in heavy else rows.join(right, key)

    # A customer table too large to broadcast is joined to the orders first, which are fewer than the lines.
    late = fits_broadcast(customers)
    if not late:
        orders = spread_join(orders, customers, ["c_custkey"])
    rows = with_large(lines, "l_orderkey", orders)
    # Shuffles come before the joins that widen the rows without one.  The parts are the last of them: their sales come to lie
    # together, so that what is grouped by part later shrinks before it is shuffled.
    if "l_suppkey" in large:
        rows = with_large(rows, "l_suppkey", suppliers)
    rows = with_large(rows, "l_partkey", parts)
    if "l_suppkey" not in large:
        rows = with_large(rows, "l_suppkey", suppliers)
    if late:
        rows = rows.join(customers, "c_custkey")
    rows = _with_region(spark, sf_dir, rows)

    renewed = F.year("o_orderdate") >= 1999
    price = F.col("p_retailprice").cast("decimal(10,2)")

    def suffix(when: Column, text: str) -> Column:
        return F.when(when & renewed, text).otherwise("")

    rows = rows.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_line"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.concat(F.lit("CUST"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.concat("c_name", suffix(F.col("c_custkey") % 7 == 0, " II")).alias("customer_name"),
        F.concat(F.lit("PROD"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat("p_brand", suffix(F.col("l_partkey") % 5 == 0, " v2")).alias("brand"),
        F.concat(F.lit("STORE"), F.col("l_suppkey").cast("string")).alias("store_id"),
        F.concat("s_name", suffix(F.col("l_suppkey") % 3 == 0, " Outlet")).alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("unit_price"),
        (price * F.col("l_discount").cast("decimal(10,2)")).alias("discount"),
        (price * F.lit(0.6).cast("decimal(1,1)")).alias("cost"),
        F.when(F.col("l_returnflag") == "A", "BLACKFRIDAY").when(F.col("l_returnflag") == "R", "SUMMERSALE")
        .alias("promo_code"),
        year_start("o_orderdate").alias(INGEST_TS),
    )
    return conform(rows, with_ingest_ts(SALES))


SALES_SQL = """
lines AS (
  SELECT * FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
                              l_suppkey DESC, l_quantity DESC, l_discount DESC, l_returnflag DESC) AS pick
    FROM lineitem) WHERE pick = 1),
sales AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_line, CAST(o_orderdate AS DATE) AS order_date,
         'CUST' || c_custkey AS customer_id,
         c_name || CASE WHEN c_custkey % 7 = 0 AND year(o_orderdate) >= 1999 THEN ' II' ELSE '' END AS customer_name,
         'PROD' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_brand || CASE WHEN p_partkey % 5 = 0 AND year(o_orderdate) >= 1999 THEN ' v2' ELSE '' END AS brand,
         'STORE' || s_suppkey AS store_id,
         s_name || CASE WHEN s_suppkey % 3 = 0 AND year(o_orderdate) >= 1999 THEN ' Outlet' ELSE '' END AS store_name,
         n_name AS city, r_name AS state, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_discount AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS discount,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS cost,
         CASE l_returnflag WHEN 'A' THEN 'BLACKFRIDAY' WHEN 'R' THEN 'SUMMERSALE' END AS promo_code,
         date_trunc('year', o_orderdate) AS ingest_ts
  FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def sql_key(*columns: str) -> str:
    """A surrogate key, spelled out."""
    parts = [
        f"coalesce(replace(replace(CAST({c} AS VARCHAR), '\\', '\\\\'), '|', '\\|'), '\\N')" for c in columns
    ]
    return f"sha256(concat_ws('|', {', '.join(parts)}))"


def two_steps_sql(name: str, extra: tuple[str, ...] = (), early: str = "ingest_ts <= TIMESTAMP '1998-01-01'",
                  late: str = "ingest_ts <= TIMESTAMP '2001-01-01'") -> str:
    """A dimension of the sales in two steps, spelled out: versions that stayed, were closed, or were opened."""
    key, attributes, (natural,) = SALES_DIMENSIONS[name]
    shown_as = {a: f"coalesce({a}, 'unknown')" if name == "dim_promo" else a for a in attributes}

    def as_of(seen: str) -> str:
        wide = ", ".join(f"{shown_as[a]} AS {a}" for a in attributes)
        hashed = f"CASE WHEN {natural} IS NULL THEN '{UNKNOWN_KEY}' ELSE {sql_key(natural)} END"
        order = ", ".join(f"{a} DESC" for a in attributes)
        return f"""
          SELECT * EXCLUDE (pick) FROM (
            SELECT {hashed} AS {key}, {wide}, max(ingest_ts) AS source_ingest_ts,
                   row_number() OVER (PARTITION BY {natural} ORDER BY max(ingest_ts) DESC, {order}) AS pick
            FROM sales WHERE {seen} GROUP BY {', '.join(attributes)}) WHERE pick = 1"""

    same = " AND ".join(f"e.{a} = l.{a}" for a in attributes)
    stored = ", ".join(f"e.{c}" for c in (key, *attributes, "source_ingest_ts"))
    opened = ", ".join(f"l.{c}" for c in (key, *attributes, "source_ingest_ts"))
    from_contacts = "".join(f", c.{c}" for c in extra)
    no_contacts = "".join(", NULL" for _ in extra)
    contact = "LEFT JOIN newest c USING (customer_id)" if extra else ""
    columns = ", ".join((key, *attributes, *extra))
    start, end = sql_ts("scd_start_ts"), sql_ts("scd_end_ts")
    return f"""
early AS ({as_of(early)}), late AS ({as_of(late)}),
versions AS (
  SELECT {stored}{from_contacts}, TIMESTAMP '1998-01-01' AS scd_start_ts, CAST(NULL AS TIMESTAMP) AS scd_end_ts,
         true AS scd_is_current
  FROM early e JOIN late l USING ({key}) {contact.replace('USING (customer_id)', 'ON c.customer_id = e.customer_id')}
  WHERE {same}
  UNION ALL
  SELECT {stored}{no_contacts}, TIMESTAMP '1998-01-01', TIMESTAMP '2001-01-01', false
  FROM early e JOIN late l USING ({key}) WHERE NOT ({same})
  UNION ALL
  SELECT {opened}{from_contacts}, TIMESTAMP '2001-01-01', NULL, true
  FROM late l LEFT JOIN early e USING ({key}) {contact.replace('USING (customer_id)', 'ON c.customer_id = l.customer_id')}
  WHERE e.{key} IS NULL OR NOT ({same}))
SELECT {columns}, {sql_ts('source_ingest_ts')} AS source_ingest_ts, {start} AS scd_start_ts, {end} AS scd_end_ts,
       scd_is_current
FROM versions"""


# --- contacts --------------------------------------------------------------------------------------------

def contacts_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contact for every customer, of which one in five does not know its customer; one in ten has a second, older one."""
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    customers = _with_region(spark, sf_dir, customers)
    n = F.col("c_custkey")
    which = F.explode(F.when(n % 10 == 3, F.array(F.lit("A"), F.lit("B"))).otherwise(F.array(F.lit("A"))))
    rows = customers.withColumn("which", which).select(
        F.concat("which", n.cast("string")).alias("contact_id"),
        F.when(n % 5 != 0, F.concat(F.lit("CUST"), n.cast("string"))).alias("customer_id"),
        F.concat(F.lit("First"), n.cast("string")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lower("which"), F.lit("."), n.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad(n.cast("string"), 9, "0")).alias("phone"),
        F.concat(F.lit("Street "), (n % 100).cast("string")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad((n % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.lit("USA").alias("country"),
        F.when(n % 2 == 0, "Manager").otherwise("Sales Rep").alias("job_title"),
        utc_literal(EARLY).alias("created_at"),
        F.when(F.col("which") == "A", utc_literal(LATE)).otherwise(utc_literal(EARLY)).alias("updated_at"),
    )
    return conform(rows, CONTACTS)


CONTACTS_SQL = """
contacts AS (
  SELECT which || c_custkey AS contact_id, CASE WHEN c_custkey % 5 <> 0 THEN 'CUST' || c_custkey END AS customer_id, 'First' || c_custkey AS first_name,
         c_name AS last_name, lower(which) || '.' || c_custkey || '@example.com' AS email,
         '+1-555-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone, 'Street ' || (c_custkey % 100) AS address,
         n_name AS city, r_name AS state, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
         'USA' AS country, CASE WHEN c_custkey % 2 = 0 THEN 'Manager' ELSE 'Sales Rep' END AS job_title,
         CASE which WHEN 'A' THEN TIMESTAMP '2001-01-01' ELSE TIMESTAMP '1998-01-01' END AS updated_at
  FROM (SELECT 'A' AS which, * FROM customer UNION ALL SELECT 'B', * FROM customer WHERE c_custkey % 10 = 3)
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


# --- stations --------------------------------------------------------------------------------------------

A_EVENTS = ("view", "click", "signup")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _flag(low: int, yes: str | int, no: str | int) -> Column:
    value = F.col("value")
    return F.when(value < 1, None).when(value >= low, yes).otherwise(no)


def _text(prefix: str, column: Column) -> Column:
    return F.concat(F.lit(prefix), column.cast("string"))


def _hours() -> Column:
    return F.when(F.col("user_id") % 3 != 0, "24h")


def _geo() -> Column:
    near = F.col("user_id") / 1000
    return F.struct((F.lit(2.0) + near).alias("lon"), (F.lit(48.0) + near).alias("lat"))


def status_a_raw(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Text flags, coordinates in a struct, some missing station codes and malformed due dates.

    ``keep`` names columns of the events to carry along.
    """
    u, k = F.col("user_id"), F.col("k")
    rows = _events(spark, sf_dir).filter(F.col("event_type").isin(*A_EVENTS)).select(
        F.when(F.col("event_id") % 101 != 0, u.cast("string")).alias("stationcode"),
        _text("Station ", u).alias("name"),
        _flag(2, "OUI", "NON").alias("is_installed"),
        (100 - k).alias("numdocksavailable"),
        k.alias("numbikesavailable"),
        F.floor(k / 2).cast("int").alias("mechanical"),
        (k - F.floor(k / 2)).cast("int").alias("ebike"),
        _flag(10, "OUI", "NON").alias("is_renting"),
        _flag(20, "OUI", "NON").alias("is_returning"),
        F.when(F.col("event_id") % 50 == 0, "nope").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("duedate"),
        _geo().alias("coordonnees_geo"),
        _text("District ", u % 20).alias("nom_arrondissement_communes"),
        F.lpad((u % 1000).cast("string"), 5, "0").alias("code_insee_commune"),
        _hours().alias("station_opening_hours"),
        F.col("ts").alias("timestamp"),
        F.date_trunc("day", "ts").alias(INGEST_TS),
        *(keep or []),
    )
    return conform(rows, with_ingest_ts(STATUS_A_SOURCE), keep_extra=True)


def status_b_raw(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """1/0 flags, epoch seconds, some report times before 1900."""
    u, k, seconds = F.col("user_id"), F.col("k"), F.unix_seconds(F.col("ts"))
    rows = _events(spark, sf_dir).filter(~F.col("event_type").isin(*A_EVENTS)).select(
        u.alias("station_id"), seconds.alias("last_updated"), k.alias("num_bikes_available"),
        (k % 5).alias("num_bikes_disabled"), (100 - k).alias("num_docks_available"),
        (k % 3).alias("num_docks_disabled"), _flag(2, 1, 0).alias("is_installed"),
        _flag(10, 1, 0).alias("is_renting"), _flag(20, 1, 0).alias("is_returning"),
        F.when(F.col("event_id") % 97 == 0, F.lit(-3000000000)).otherwise(seconds - k).alias("last_reported"),
        F.date_trunc("day", "ts").alias(INGEST_TS),
        *(keep or []),
    )
    return conform(rows, with_ingest_ts(STATUS_B_SOURCE), keep_extra=True)


def _per_week(events: DataFrame, columns: list[str]) -> DataFrame:
    """Last event of every station and week."""
    rows = events.select(F.date_trunc("week", "ts").alias(INGEST_TS), "user_id", "ts", "event_id", *columns)
    return one_row_per_key(rows, ["user_id", INGEST_TS], ["ts", "event_id"])


def info_a_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly station attributes; the capacity changes from time to time."""
    u = F.col("user_id")
    rows = _per_week(_events(spark, sf_dir).filter(F.col("event_type").isin(*A_EVENTS)), ["k"]).select(
        u.cast("string").alias("stationcode"), _text("Station ", u).alias("name"),
        (20 + F.col("k") % 3).alias("capacity"), _geo().alias("coordonnees_geo"),
        _hours().alias("station_opening_hours"), INGEST_TS,
    )
    return conform(rows, with_ingest_ts(INFO_A_SOURCE))


def info_b_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    geo = _geo()
    rows = _per_week(_events(spark, sf_dir).filter(~F.col("event_type").isin(*A_EVENTS)), ["k"]).select(
        u.alias("station_id"), _text("Stop ", u).alias("name"), geo["lat"].alias("lat"), geo["lon"].alias("lon"),
        _text("Street ", u).alias("address"), F.when(u % 4 == 0, "").otherwise("card,key").alias("rental_methods"),
        (30 + F.col("k") % 2).alias("capacity"), F.unix_seconds(F.col("ts")).alias("last_updated"), INGEST_TS,
    )
    return conform(rows, with_ingest_ts(INFO_B_SOURCE))


def _flag_sql(low: int, yes: str, no: str) -> str:
    return f"CASE WHEN value < 1 THEN NULL WHEN value >= {low} THEN {yes} ELSE {no} END"


EVENTS_SQL = """
ev AS (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k,
              event_type IN ('view', 'click', 'signup') AS is_a FROM events)
"""

STATIONS_SQL = f"""
{EVENTS_SQL},
status_a AS (
  SELECT CASE WHEN event_id % 101 <> 0 THEN CAST(user_id AS VARCHAR) END AS stationcode,
         'Station ' || user_id AS name, {_flag_sql(2, 'true', 'false')} AS is_installed,
         100 - k AS numdocksavailable, k AS numbikesavailable, k // 2 AS mechanical, k - k // 2 AS ebike,
         {_flag_sql(10, 'true', 'false')} AS is_renting, {_flag_sql(20, 'true', 'false')} AS is_returning,
         CASE WHEN event_id % 50 = 0 THEN 'nope' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS duedate,
         CAST(2 AS DOUBLE) + user_id / 1000 AS longitude, CAST(48 AS DOUBLE) + user_id / 1000 AS latitude,
         'District ' || (user_id % 20) AS nom_arrondissement_communes,
         lpad(CAST(user_id % 1000 AS VARCHAR), 5, '0') AS code_insee_commune,
         CASE WHEN user_id % 3 <> 0 THEN '24h' END AS station_opening_hours,
         ts AS "timestamp", date_trunc('day', ts) AS ingest_ts
  FROM ev WHERE is_a),
status_b AS (
  SELECT CAST(user_id AS INTEGER) AS station_id, date_trunc('second', ts) AS last_updated, k AS num_bikes_available,
         k % 5 AS num_bikes_disabled, 100 - k AS num_docks_available, k % 3 AS num_docks_disabled,
         {_flag_sql(2, 'true', 'false')} AS is_installed, {_flag_sql(10, 'true', 'false')} AS is_renting,
         {_flag_sql(20, 'true', 'false')} AS is_returning,
         date_trunc('second', ts) - to_seconds(k) AS last_reported, event_id, date_trunc('day', ts) AS ingest_ts
  FROM ev WHERE NOT is_a),
status_a_clean AS (
  SELECT * EXCLUDE (pick) FROM (
    SELECT *, row_number() OVER (PARTITION BY stationcode, "timestamp" ORDER BY ingest_ts DESC) AS pick
    FROM status_a WHERE stationcode IS NOT NULL) WHERE pick = 1),
status_b_clean AS (
  SELECT * EXCLUDE (pick, event_id) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, last_updated ORDER BY ingest_ts DESC,
             num_bikes_available DESC, is_installed DESC NULLS LAST, is_renting DESC NULLS LAST,
             is_returning DESC NULLS LAST, last_reported DESC) AS pick
    FROM status_b WHERE event_id % 97 <> 0) WHERE pick = 1),
weekly AS (
  SELECT * FROM (SELECT *, date_trunc('week', ts) AS ingest_ts,
      row_number() OVER (PARTITION BY is_a, user_id, date_trunc('week', ts) ORDER BY ts DESC, event_id DESC) AS pick
    FROM ev) WHERE pick = 1),
info_a AS (
  SELECT CAST(user_id AS VARCHAR) AS stationcode, 'Station ' || user_id AS name, 20 + k % 3 AS capacity,
         CASE WHEN user_id % 3 <> 0 THEN '24h' END AS station_opening_hours,
         CAST(2 AS DOUBLE) + user_id / 1000 AS longitude, CAST(48 AS DOUBLE) + user_id / 1000 AS latitude, ingest_ts
  FROM weekly WHERE is_a),
info_b AS (
  SELECT CAST(user_id AS INTEGER) AS station_id, 'Stop ' || user_id AS name,
         CAST(48 AS DOUBLE) + user_id / 1000 AS lat, CAST(2 AS DOUBLE) + user_id / 1000 AS lon,
         'Street ' || user_id AS address, CASE WHEN user_id % 4 = 0 THEN '' ELSE 'card,key' END AS rental_methods,
         30 + k % 2 AS capacity, date_trunc('second', ts) AS last_updated, ingest_ts
  FROM weekly WHERE NOT is_a)
"""


def scd2_sql(batches: str, key: str, change: list[str], columns: list[str], ts: str = "ingest_ts") -> str:
    """Full type 2 history of a relation of batches, by window functions over all of them at once."""
    order = f"OVER (PARTITION BY {key} ORDER BY {ts})"
    differs = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) {order}" for c in change)
    return f"""
      SELECT {', '.join(columns)}, {ts} AS scd_start_ts, lead({ts}) {order} AS scd_end_ts
      FROM (SELECT *, row_number() {order} = 1 OR {differs} AS opens FROM {batches}) WHERE opens"""
