"""Append, keyed merge, delete, partition- and range-pruned merge, schema evolution, load audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.scalars import utc_datetime, utc_literal
from stratamart.operators.audit import audit_row
from stratamart.operators.conform import current_only
from stratamart.operators.merge import delete_keys, merge_actions, upsert
from stratamart.operators.scd2 import paired_actions, rebuild_scd2
from stratamart.plans.ingestion import (
    CLEAN_CONTACTS, CLEAN_SALES, RAW_CONTACTS, RAW_INFO_A, RAW_SALES, contacts_pipeline, info_a_pipeline, sales_pipeline,
)
from stratamart.plans.runs import read_table, run_pipeline
from stratamart.registry.inputs import (
    CONTACTS_SQL, EARLY, LATE, SALES_SQL, STATIONS_SQL, contacts_source, ids, info_a_raw, sales_source, shown, sql_ts, table,
    year_start,
)
from stratamart.sources.tables import PartitionedTable, SnapshotTable, append_batch, scratch_dir, staged
from stratamart.spec import INGEST_TS

NEWEST = ["o_orderdate", "o_orderkey"]
AUDITED = ("insert", "update", "ignore", "delete")


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in yearly batches; as a table keyed by customer, most keys come back in later batches."""
    return table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice",
        year_start("o_orderdate").alias(INGEST_TS),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[datetime]]:
    """The batches landed in one raw table, partitioned by batch, and the batch timestamps."""
    path = scratch_dir(spark)
    orders = customer_orders(spark, sf_dir)
    append_batch(orders, path, [INGEST_TS], rebalance=True)
    raw = PartitionedTable(spark, path, [INGEST_TS], orders.schema).read()
    return raw, ids(raw, INGEST_TS)


def batch_of(raw: DataFrame, at: datetime) -> DataFrame:
    return raw.filter(F.col(INGEST_TS) == utc_literal(at))


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches appended, the last one twice."""
    path = scratch_dir(spark)
    orders = customer_orders(spark, sf_dir)
    append_batch(orders, path, [INGEST_TS], rebalance=True)
    last = utc_datetime(orders.agg(F.unix_micros(F.max(INGEST_TS))).first()[0])
    append_batch(batch_of(orders, last), path, [INGEST_TS])
    raw = PartitionedTable(spark, path, [INGEST_TS], orders.schema).read()
    return shown(raw.groupBy(INGEST_TS).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("key_sum")))


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order per customer, batch after batch."""
    raw, batches = raw_orders(spark, sf_dir)
    newest = SnapshotTable(spark, scratch_dir(spark), raw.schema)
    for number, at in enumerate(batches):
        newest.merge(batch_of(raw, at), ["o_custkey"], number, version=INGEST_TS, order_by=NEWEST)
    return shown(newest.read())


def merge_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches arriving newest first: the version column keeps the result the same."""
    raw, batches = raw_orders(spark, sf_dir)
    newest = SnapshotTable(spark, scratch_dir(spark), raw.schema)
    for number, at in enumerate(reversed(batches)):
        newest.merge(batch_of(raw, at), ["o_custkey"], number, version=INGEST_TS, order_by=NEWEST)
    return shown(newest.read())


def merge_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without those of customers in debt."""
    debtors = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return delete_keys(orders, debtors, ["o_custkey"])


def _order_year(df: DataFrame) -> DataFrame:
    return df.withColumn("order_year", F.year("o_orderdate"))


def merge_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch changes a third of the 1999 orders and adds orders to 2000; other years are not touched."""
    orders = _order_year(customer_orders(spark, sf_dir)).drop(INGEST_TS)
    target = PartitionedTable(spark, scratch_dir(spark), ["order_year"], orders.schema)
    target.merge(orders, ["o_orderkey"])
    changed = orders.filter((F.col("order_year") == 1999) & (F.col("o_orderkey") % 3 == 0)).withColumns(
        {"o_orderstatus": F.lit("U"), "o_totalprice": F.col("o_totalprice") + 1})
    added = orders.filter((F.col("order_year") == 2000) & (F.col("o_orderkey") % 10 == 0)).withColumns(
        {"o_orderkey": F.col("o_orderkey") + 1_000_000_000_000, "o_orderstatus": F.lit("N")})
    target.merge(changed.unionByName(added), ["o_orderkey"])
    return shown(target.read())


def _with_holes(df: DataFrame) -> DataFrame:
    """The order year, unknown for every order whose key ends in 7."""
    return df.withColumn("order_year", F.when(F.col("o_orderkey") % 10 != 7, F.year("o_orderdate")))


def merge_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year, some without one: a batch changes a part of those without, and orders of that part are deleted."""
    orders = _with_holes(customer_orders(spark, sf_dir).drop(INGEST_TS))
    target = PartitionedTable(spark, scratch_dir(spark), ["order_year"], orders.schema)
    target.merge(orders, ["o_orderkey"])
    changed = orders.filter(F.col("order_year").isNull() & (F.col("o_orderkey") % 3 == 0)).withColumn("o_orderstatus", F.lit("U"))
    gone = orders.filter(F.col("o_orderkey") % 50 == 27).select("o_orderkey")
    target.merge(changed, ["o_orderkey"], deletes=gone)
    return shown(target.read())


def merge_key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upper half of the orders changes; those below its key range bypass the merge join."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    middle = orders.agg(F.floor(F.max("o_orderkey") / 2)).first()[0]
    batch = orders.filter(F.col("o_orderkey") >= middle).withColumn("o_orderstatus", F.lit("U"))
    return upsert(orders, batch, ["o_orderkey"], key_range="o_orderkey")


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch brings a new column and a wider type, and lacks a stored column."""
    customers = table(spark, sf_dir, "customer")
    stored = customers.filter(F.col("c_custkey") % 3 != 1).select("c_custkey", "c_nationkey", "c_name")
    batch = customers.filter(F.col("c_custkey") % 3 != 2).select(
        "c_custkey", F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "c_mktsegment")
    target = SnapshotTable(spark, scratch_dir(spark), stored.schema)
    target.merge(stored, ["c_custkey"], 0)
    target.merge(batch, ["c_custkey"], 1)
    return target.read()


def nested_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run of source A brings coordinates with an altitude; the raw table and a merged one take the field in."""
    info, root = staged(info_a_raw(spark, sf_dir)), scratch_dir(spark)
    weeks = ids(info, INGEST_TS)
    merged = SnapshotTable(spark, scratch_dir(spark))
    for number, at in enumerate((weeks[0], weeks[-1])):
        week = batch_of(info, at).drop(INGEST_TS)
        if number:
            high = F.struct("coordonnees_geo.*", F.col("capacity").cast("double").alias("alt"))
            week = week.withColumn("coordonnees_geo", high)
        run_pipeline(spark, info_a_pipeline(lambda _, week=week: week), root, number, at)
        merged.merge(week.select("stationcode", "coordonnees_geo"), ["stationcode"], number)
    geo = [F.col(f"coordonnees_geo.{c}").alias(c) for c in ("lon", "lat", "alt")]
    raw = read_table(spark, RAW_INFO_A, root).select(F.lit("raw").alias("layer"), "stationcode", *geo, INGEST_TS)
    kept = merged.read().select(F.lit("merged").alias("layer"), "stationcode", *geo, F.lit(None).cast("timestamp").alias(INGEST_TS))
    return shown(raw.unionByName(kept))


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each yearly batch would do to the customers known before it, and what a delete would remove."""
    orders = staged(customer_orders(spark, sf_dir))
    debtors = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("o_custkey"))
    out = None
    for at in ids(orders, INGEST_TS):
        known = orders.filter(F.col(INGEST_TS) < utc_literal(at)).groupBy("o_custkey").agg(F.max(INGEST_TS).alias(INGEST_TS))
        actions = merge_actions(known, batch_of(orders, at).select("o_custkey", INGEST_TS), ["o_custkey"],
                                version=INGEST_TS, deletes=debtors)
        row = audit_row(actions, "newest_orders", at, AUDITED)
        out = row if out is None else out.unionByName(row)
    return shown(out)


def scd2_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the 2001 order priorities would do to the type 2 table of all earlier ones."""
    orders = customer_orders(spark, sf_dir).select("o_custkey", "o_orderpriority", *NEWEST, INGEST_TS)
    key, change = ["o_custkey"], ["o_orderpriority"]
    earlier = rebuild_scd2(orders.filter(F.col(INGEST_TS) < utc_literal(LATE)), key, change, INGEST_TS, order_by=NEWEST)
    last = batch_of(orders, LATE).drop(INGEST_TS)
    actions = paired_actions(staged(current_only(earlier)), last, key, change, order_by=NEWEST)
    kinds = ("insert", "change", "unchanged", "keep")
    return shown(audit_row(actions, "priorities", LATE, kinds))


def ingest_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales landed and merged in two runs, the second one repeated; raw and cleaned rows per state."""
    sales, root = staged(sales_source(spark, sf_dir)), scratch_dir(spark)
    for number, at in ((0, EARLY), (1, LATE), (1, LATE)):
        run_pipeline(spark, sales_pipeline(
            lambda _, at=at: sales.filter(F.col(INGEST_TS) <= utc_literal(at)).drop(INGEST_TS)), root, number, at)
    raw = read_table(spark, RAW_SALES, root).withColumn("layer", F.lit("raw"))
    clean = read_table(spark, CLEAN_SALES, root).withColumn("layer", F.lit("clean"))
    counts = raw.unionByName(clean).groupBy("layer", INGEST_TS, "state").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("quantity").alias("quantity"))
    return shown(counts)


def ingest_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts in two runs; the source of the second has a column more, which both layers keep."""
    contacts, root = contacts_source(spark, sf_dir), scratch_dir(spark)
    run_pipeline(spark, contacts_pipeline(lambda _: contacts), root, 0, EARLY)
    wider = contacts.filter(F.col("contact_id").startswith("A")).withColumn("channel", F.upper("job_title"))
    run_pipeline(spark, contacts_pipeline(lambda _: wider), root, 1, LATE)
    raw, clean = read_table(spark, RAW_CONTACTS, root), read_table(spark, CLEAN_CONTACTS, root)
    picked = [df.select(F.lit(layer).alias("layer"), "contact_id", "job_title", "channel", INGEST_TS)
              for layer, df in (("raw", raw), ("clean", clean))]
    return shown(picked[0].unionByName(picked[1]))


def ingest_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts landed and merged in two runs; the second one deletes those in one city."""
    contacts, root = contacts_source(spark, sf_dir), scratch_dir(spark)
    run_pipeline(spark, contacts_pipeline(lambda _: contacts.filter(~F.col("contact_id").endswith("7"))), root, 0, EARLY)
    pipeline = contacts_pipeline(lambda _: contacts.filter(F.col("contact_id").startswith("A")))
    gone = contacts.filter(F.col("city") == "NATION_3").select("contact_id")
    pipeline = type(pipeline)(pipeline.name, pipeline.bronze, pipeline.silver, pipeline.source, deletes=lambda _: gone)
    run_pipeline(spark, pipeline, root, 1, LATE)
    return shown(read_table(spark, CLEAN_CONTACTS, root).select("contact_id", "customer_id", "city", "email",
                                                               "updated_at", INGEST_TS))


QUERIES = {
    "append_batches": append_batches,
    "merge_upsert": merge_upsert,
    "merge_out_of_order": merge_out_of_order,
    "merge_delete": merge_delete,
    "merge_pruned": merge_pruned,
    "merge_null_partition": merge_null_partition,
    "merge_key_range": merge_key_range,
    "ingest_evolving": ingest_evolving,
    "schema_evolution": schema_evolution,
    "nested_evolution": nested_evolution,
    "load_audit": load_audit,
    "scd2_audit": scd2_audit,
    "ingest_sales": ingest_sales,
    "ingest_contacts": ingest_contacts,
}

NEWEST_ORDER_SQL = f"""
SELECT o_custkey, o_orderkey, {sql_ts('o_orderdate')} AS o_orderdate, o_orderpriority, o_orderstatus, o_totalprice,
       {sql_ts("date_trunc('year', o_orderdate)")} AS ingest_ts
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

ORACLES = {
    "append_batches": f"""
SELECT {sql_ts("date_trunc('year', o_orderdate)")} AS ingest_ts, count(*) AS rows,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 1""",
    "merge_upsert": NEWEST_ORDER_SQL,
    "merge_out_of_order": NEWEST_ORDER_SQL,
    "merge_delete": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "merge_pruned": f"""
WITH kept AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority,
         CASE WHEN year(o_orderdate) = 1999 AND o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN year(o_orderdate) = 1999 AND o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END
           AS o_totalprice FROM orders
  UNION ALL
  SELECT o_custkey, o_orderkey + 1000000000000, o_orderdate, o_orderpriority, 'N', o_totalprice
  FROM orders WHERE year(o_orderdate) = 2000 AND o_orderkey % 10 = 0)
SELECT * REPLACE ({sql_ts('o_orderdate')} AS o_orderdate), CAST(year(o_orderdate) AS INTEGER) AS order_year FROM kept""",
    "merge_null_partition": f"""
SELECT o_custkey, o_orderkey, {sql_ts('o_orderdate')} AS o_orderdate, o_orderpriority,
       CASE WHEN o_orderkey % 10 = 7 AND o_orderkey % 3 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
       CASE WHEN o_orderkey % 10 <> 7 THEN CAST(year(o_orderdate) AS INTEGER) END AS order_year
FROM orders WHERE o_orderkey % 50 <> 27""",
    "merge_key_range": """
WITH m AS (SELECT max(o_orderkey) // 2 AS middle FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey >= middle THEN 'U' ELSE o_orderstatus END
         AS o_orderstatus, o_totalprice FROM orders, m""",
    "schema_evolution": """
SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
       CASE WHEN c_custkey % 3 = 2 THEN c_name END AS c_name,
       CASE WHEN c_custkey % 3 <> 2 THEN c_mktsegment END AS c_mktsegment
FROM customer""",
    "nested_evolution": f"""
WITH {STATIONS_SQL},
bounds AS (SELECT min(ingest_ts) AS first, max(ingest_ts) AS last FROM info_a),
runs AS (SELECT stationcode, longitude AS lon, latitude AS lat, CASE WHEN ingest_ts = last THEN CAST(capacity AS DOUBLE) END AS alt,
                ingest_ts FROM info_a, bounds WHERE ingest_ts IN (first, last))
SELECT 'raw' AS layer, * REPLACE ({sql_ts('ingest_ts')} AS ingest_ts) FROM runs
UNION ALL
SELECT 'merged', stationcode, arg_max(lon, ingest_ts), arg_max(lat, ingest_ts), max(alt), NULL FROM runs GROUP BY stationcode""",
    "load_audit": f"""
WITH batches AS (SELECT DISTINCT o_custkey, date_trunc('year', o_orderdate) AS ingest_ts FROM orders),
firsts AS (SELECT o_custkey, min(ingest_ts) AS first_ts FROM batches GROUP BY o_custkey),
debtors AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
merged AS (
  SELECT ingest_ts, count(*) FILTER (WHERE ingest_ts = first_ts) AS ins,
         count(*) FILTER (WHERE ingest_ts > first_ts) AS upd
  FROM batches JOIN firsts USING (o_custkey) GROUP BY ingest_ts),
removed AS (
  SELECT ingest_ts, count(*) FILTER (WHERE first_ts <= ingest_ts AND o_custkey IN (SELECT c_custkey FROM debtors)) AS del
  FROM (SELECT DISTINCT ingest_ts FROM batches), firsts GROUP BY ingest_ts)
SELECT 'newest_orders' AS table_name, {sql_ts('ingest_ts')} AS ingest_ts, ins AS rows_insert, upd AS rows_update,
       CAST(0 AS BIGINT) AS rows_ignore, del AS rows_delete
FROM merged JOIN removed USING (ingest_ts)""",
    "scd2_audit": """
WITH picked AS (
  SELECT o_custkey, year(o_orderdate) = 2001 AS last, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p
  FROM orders GROUP BY ALL),
a AS (SELECT * FROM picked WHERE NOT last), b AS (SELECT * FROM picked WHERE last)
SELECT 'priorities' AS table_name, '2001-01-01 00:00:00.000000' AS ingest_ts,
       count(*) FILTER (WHERE a.o_custkey IS NULL) AS rows_insert,
       count(*) FILTER (WHERE a.p <> b.p) AS rows_change,
       count(*) FILTER (WHERE a.p = b.p) AS rows_unchanged,
       count(*) FILTER (WHERE b.o_custkey IS NULL) AS rows_keep
FROM a FULL JOIN b USING (o_custkey)""",
    "ingest_sales": f"""
WITH {SALES_SQL},
layers AS (
  SELECT 'raw' AS layer, TIMESTAMP '1998-01-01' AS landed, state, quantity FROM sales
  WHERE ingest_ts <= TIMESTAMP '1998-01-01'
  UNION ALL SELECT 'raw', TIMESTAMP '2001-01-01', state, quantity FROM sales
  UNION ALL SELECT 'clean', TIMESTAMP '2001-01-01', state, quantity FROM sales)
SELECT layer, {sql_ts('landed')} AS ingest_ts, state, count(*) AS rows, CAST(sum(quantity) AS BIGINT) AS quantity
FROM layers GROUP BY ALL""",
    "ingest_evolving": f"""
WITH {CONTACTS_SQL},
runs AS (
  SELECT *, TIMESTAMP '1998-01-01' AS landed, CAST(NULL AS VARCHAR) AS channel FROM contacts
  UNION ALL SELECT *, TIMESTAMP '2001-01-01', upper(job_title) FROM contacts WHERE contact_id LIKE 'A%'),
layers AS (
  SELECT 'raw' AS layer, * FROM runs
  UNION ALL (SELECT 'clean', * FROM runs QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY landed DESC) = 1))
SELECT layer, contact_id, job_title, channel, {sql_ts('landed')} AS ingest_ts FROM layers""",
    "ingest_contacts": f"""
WITH {CONTACTS_SQL},
merged AS (
  SELECT *, CASE WHEN contact_id LIKE 'A%' THEN TIMESTAMP '2001-01-01' ELSE TIMESTAMP '1998-01-01' END AS ingest_ts
  FROM contacts WHERE (contact_id LIKE 'A%' OR contact_id NOT LIKE '%7') AND city <> 'NATION_3')
SELECT contact_id, customer_id, city, email, {sql_ts('updated_at')} AS updated_at, {sql_ts('ingest_ts')} AS ingest_ts
FROM merged""",
}
