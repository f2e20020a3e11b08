"""Synthetic source batches, computed from row numbers only.

No random function: the same ids give the same rows on every run, whatever the partitioning.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.scalars import cyclic_pick, decoded, trailing_digits, utc_literal, zero_padded

# The catalogue the generated sales draw from.
PRODUCT_NAMES = {
    "PROD1": "Smartphone", "PROD2": "Headphones", "PROD3": "Monitor", "PROD4": "Keyboard", "PROD5": "Mouse",
}
PRODUCT_CATEGORIES = {
    "PROD1": "Main Device", "PROD2": "Accessory", "PROD3": "Display", "PROD4": "Accessory", "PROD5": "Accessory",
}
STORE_CITIES = {"STORE1": "New York", "STORE2": "Chicago", "STORE3": "San Francisco"}
STORE_STATES = {"STORE1": "NY", "STORE2": "IL", "STORE3": "CA"}
CITIES = ("New York", "Chicago", "San Francisco")
STATES = ("NY", "IL", "CA")

# Multiplier, increment and modulus of a common linear congruential generator.
MULTIPLIER, INCREMENT, MODULUS = 1103515245, 12345, 2147483648


def draw(row: Column, seed: int, sides: int) -> Column:
    """A number in 0 .. sides-1 that depends on the row number and the seed; never overflows a long."""
    mixed = ((row + F.lit(seed)) % MODULUS * MULTIPLIER + INCREMENT + seed) % MODULUS
    # The low bits of this generator repeat soon, so they are dropped.
    return (F.floor(mixed / 65536) % sides).cast("long")


def _cents(value: Column) -> Column:
    return (value.cast("decimal(12,2)") / F.lit(100)).cast("decimal(10,2)")


def sales_rows(ids: DataFrame, order_line: int | Column, batch_ts: datetime | Column, seed: int = 0) -> DataFrame:
    """One sales line per row of ``ids`` (column ``order_id``), shaped like the sales source."""
    row = F.col("order_id")
    line = order_line if isinstance(order_line, Column) else F.lit(order_line)
    ts = batch_ts if isinstance(batch_ts, Column) else utc_literal(batch_ts)

    def numbered(prefix: str, salt: int, sides: int) -> Column:
        return F.concat(F.lit(prefix), (draw(row, seed + salt, sides) + 1).cast("string"))

    def with_line(text: str) -> Column:
        return F.concat(F.lit(text), line.cast("string"))

    product, store, promo = F.col("product_id"), F.col("store_id"), draw(row, seed + 8, 4)
    brand = (
        F.when(product.isin("PROD1", "PROD2"), with_line("BrandA "))
        .when(product == "PROD3", "BrandB").otherwise("BrandC")
    )
    store_name = (
        F.when(store == "STORE1", with_line("New York Outlet "))
        .when(store == "STORE2", "Chicago Branch").otherwise("SF Flagship")
    )
    promo_code = (
        F.when(promo == 0, with_line("OFFER")).when(promo == 1, "BLACKFRIDAY").when(promo == 2, "SUMMERSALE")
    )
    return ids.select(
        row.cast("long").alias("order_id"),
        line.cast("int").alias("order_line"),
        F.date_sub(ts.cast("date"), draw(row, seed + 1, 90).cast("int")).alias("order_date"),
        numbered("CUST", 2, 10).alias("customer_id"),
        numbered("PROD", 3, 5).alias("product_id"),
        numbered("STORE", 4, 3).alias("store_id"),
        (draw(row, seed + 5, 5) + 1).cast("int").alias("quantity"),
        _cents(draw(row, seed + 6, 90_001) % 90_001 + 10_000).alias("unit_price"),
        _cents(draw(row, seed + 7, 3_001)).alias("discount"),
        _cents(draw(row, seed + 9, 50_001) % 50_001 + 5_000).alias("cost"),
        promo_code.alias("promo_code"),
    ).select(
        "order_id", "order_line", "order_date", "customer_id",
        F.concat(F.lit("Customer "), trailing_digits(F.col("customer_id")), F.lit(" "),
                 F.col("order_line").cast("string")).alias("customer_name"),
        "product_id",
        decoded(product, PRODUCT_NAMES, "Unknown").alias("product_name"),
        decoded(product, PRODUCT_CATEGORIES, "Unknown").alias("category"),
        brand.alias("brand"),
        "store_id",
        store_name.alias("store_name"),
        decoded(store, STORE_CITIES, "Unknown").alias("city"),
        decoded(store, STORE_STATES, "Unknown").alias("state"),
        "quantity", "unit_price", "discount", "cost", "promo_code",
    )


def sales_batch(spark: SparkSession, rows: int, order_line: int, batch_ts: datetime, seed: int = 0) -> DataFrame:
    return sales_rows(spark.range(rows).withColumnRenamed("id", "order_id"), order_line, batch_ts, seed)


def contact_rows(ids: DataFrame, batch_ts: datetime | Column) -> DataFrame:
    """One contact per row of ``ids`` (column ``id``), shaped like the contacts source."""
    n = F.col("id")
    text = n.cast("string")
    ts = (batch_ts if isinstance(batch_ts, Column) else utc_literal(batch_ts)).cast("timestamp")
    return ids.select(
        text.alias("contact_id"),
        F.concat(F.lit("CUST"), (n + 1).cast("string")).alias("customer_id"),
        F.concat(F.lit("FirstName"), text).alias("first_name"),
        F.concat(F.lit("LastName"), text).alias("last_name"),
        F.concat(F.lit("contact"), text, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-01"), _at_least(n + 1, 2)).alias("phone"),
        F.concat(F.lit("Address "), text).alias("address"),
        cyclic_pick(CITIES, n).alias("city"),
        cyclic_pick(STATES, n).alias("state"),
        F.concat(F.lit("100"), _at_least(n + 1, 2)).alias("zip_code"),
        F.lit("USA").alias("country"),
        F.when(n % 2 == 0, "Manager").otherwise("Sales Rep").alias("job_title"),
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def _at_least(number: Column, width: int) -> Column:
    # Padding must not shorten longer numbers, which lpad alone would.
    return F.when(number < 10 ** width, zero_padded(number, width)).otherwise(number.cast("string"))


def contacts_batch(spark: SparkSession, rows: int, batch_ts: datetime) -> DataFrame:
    return contact_rows(spark.range(rows), batch_ts)
