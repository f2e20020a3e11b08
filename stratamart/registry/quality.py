"""Key, reference and required-column checks on tables with known defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.operators.quality import check_table, duplicate_keys, null_counts, orphans
from stratamart.plans.dimensions import calendar_of, sales_dimension
from stratamart.plans.facts import FACT_SALES, sales_fact
from stratamart.plans.runs import log_findings
from stratamart.registry.inputs import LOADED_AT, SALES_SQL, sales_source, shown, table
from stratamart.sources.files import delete_path
from stratamart.sources.tables import read_or_empty, scratch_dir, staged


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines that occur more than once."""
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of suppliers missing from a cut supplier table."""
    suppliers = table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 10 != 3)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return orphans(lines, suppliers, ["l_suppkey"], ["s_suppkey"])


def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column of a customer table with holes."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
    )
    return null_counts(rows, rows.columns)


def quality_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of the sales fact against its dimensions, logged.

    Some sales keys are doubled, the stores of one region and the unknown promotion are missing, and one
    amount is NULL here and there.
    """
    source = scratch_dir(spark)
    sales = staged(sales_source(spark, sf_dir), source)
    fact = sales_fact(sales, LOADED_AT)
    fact = fact.unionByName(fact.filter(F.col("order_id") % 100 == 0))
    fact = staged(fact.withColumn("cost", F.when(F.col("order_id") % 50 != 1, F.col("cost"))))
    references = {name: sales_dimension(name, sales, LOADED_AT) for name in (
        "dim_customer", "dim_product", "dim_store", "dim_promo")}
    references["dim_store"] = references["dim_store"].filter(F.col("state") != "ASIA")
    references["dim_promo"] = references["dim_promo"].filter(F.col("promo_code") != "unknown")
    references["dim_date"] = calendar_of(sales, "order_date", LOADED_AT)
    references = {name: staged(dimension) for name, dimension in references.items()}
    delete_path(spark, source)  # what is checked is stored by now
    path = scratch_dir(spark)
    found = check_table(FACT_SALES, fact, references, LOADED_AT)
    log_findings(found, path)
    return shown(read_or_empty(spark, path, found.schema).filter(F.col("violations") > 0))


QUERIES = {
    "pk_duplicates": pk_duplicates,
    "fk_orphans": fk_orphans,
    "null_violations": null_violations,
    "quality_findings": quality_findings,
}

ORACLES = {
    "pk_duplicates": """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "fk_orphans": """
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_suppkey % 10 <> 3)""",
    "null_violations": """
SELECT unnest(['c_custkey', 'c_name', 'c_mktsegment', 'c_acctbal']) AS columns,
       unnest([0, count(*) FILTER (WHERE c_custkey % 11 = 0), count(*) FILTER (WHERE c_mktsegment = 'BUILDING'),
               count(*) FILTER (WHERE c_acctbal < 0)]) AS violations
FROM customer""",
    "quality_findings": f"""
WITH {SALES_SQL},
fact AS (
  SELECT * FROM sales UNION ALL SELECT * FROM sales WHERE order_id % 100 = 0),
found AS (
  SELECT 'primary_key' AS check_name, 'sales_key' AS columns,
         (SELECT count(*) FROM sales WHERE order_id % 100 = 0) AS violations
  UNION ALL SELECT 'not_null', 'cost', count(*) FROM fact WHERE order_id % 50 = 1
  UNION ALL SELECT 'foreign_key:dim_store', 'store_key', count(*) FROM fact WHERE state = 'ASIA'
  UNION ALL SELECT 'foreign_key:dim_promo', 'promo_key', count(*) FROM fact WHERE promo_code IS NULL)
SELECT 'fact_sales' AS table_name, check_name, columns, violations, '2024-06-01 00:00:00.000000' AS ingest_ts
FROM found WHERE violations > 0""",
}
