"""The six dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.keys import UNKNOWN_KEY, member_key, surrogate_key
from stratamart.functions.scalars import WEEKEND_DAYS, calendar_columns
from stratamart.operators.conform import conform, current_only, stamp
from stratamart.operators.latest import latest_per_key
from stratamart.operators.lookup import conformed_union, enrich_left
from stratamart.plans.ingestion import GOLD
from stratamart.spec import INGEST_TS, SOURCE_INGEST_TS, Model, SaveMode, TableSpec, schema_of

SOURCE_A, SOURCE_B = "source_a", "source_b"
# Shown by the unknown member of a dimension in place of its missing attributes.
UNKNOWN_LABEL = "unknown"

# Attributes of the dimensions taken from sales, and the natural key of each.
SALES_DIMENSIONS = {
    "dim_customer": ("customer_key", ("customer_id", "customer_name"), ("customer_id",)),
    "dim_product": ("product_key", ("product_id", "product_name", "category", "brand"), ("product_id",)),
    "dim_store": ("store_key", ("store_id", "store_name", "city", "state"), ("store_id",)),
    "dim_promo": ("promo_key", ("promo_code",), ("promo_code",)),
}
CONTACT_COLUMNS = (
    "contact_id", "first_name", "last_name", "email", "phone", "address", "city", "state", "zip_code", "country",
    "job_title",
)


def _spec(name: str, key: str, attributes: Sequence[str], overwrite: Sequence[str] = ()) -> TableSpec:
    columns = {c: "string" for c in (key, *attributes)} | {SOURCE_INGEST_TS: "timestamp", INGEST_TS: "timestamp"}
    return TableSpec(name, GOLD, schema_of(columns, tuple(columns)), SaveMode.MERGE_SCD2, (key,),
                     change_columns=tuple(attributes), overwrite_columns=tuple(overwrite))


# Keys and columns of the dimensions.
DIM_CUSTOMER = _spec("dim_customer", *SALES_DIMENSIONS["dim_customer"][:2], overwrite=CONTACT_COLUMNS)
DIM_PRODUCT = _spec("dim_product", *SALES_DIMENSIONS["dim_product"][:2])
DIM_STORE = _spec("dim_store", *SALES_DIMENSIONS["dim_store"][:2])
DIM_PROMO = _spec("dim_promo", *SALES_DIMENSIONS["dim_promo"][:2])

DIM_DATE = TableSpec("dim_date", GOLD, schema_of({
    "date_key": "string", "date": "date", "year": "integer", "month": "integer", "day": "integer",
    "week": "integer", "quarter": "integer", "day_of_week": "integer", "is_weekend": "boolean",
    INGEST_TS: "timestamp",
}, required=("date_key", "date", "year", "month", "day", "week", "quarter", "day_of_week", "is_weekend")),
    SaveMode.MERGE, ("date_key",))

DIM_BIKE_STATION = TableSpec("dim_bike_station", GOLD, schema_of({
    "station_key": "string", "station_source": "string", "station_id": "string", "station_name": "string",
    "capacity": "integer", "station_opening_hours": "string", "longitude": "double", "latitude": "double",
    "address": "string", SOURCE_INGEST_TS: "timestamp", INGEST_TS: "timestamp",
}, required=("station_key", SOURCE_INGEST_TS, INGEST_TS)), SaveMode.MERGE_SCD2, ("station_key",),
    change_columns=("station_name", "capacity", "longitude", "latitude", "station_opening_hours", "address"))


def generate_dimension(
    source: DataFrame,
    attributes: Sequence[str],
    natural_key: Sequence[str],
    key: str,
    batch_ts: datetime | Column,
    *,
    key_of: str = "natural",
) -> DataFrame:
    """Distinct attribute rows of a source table with their surrogate key and latest ingest timestamp.

    ``key_of="natural"`` hashes the natural key, so changed attributes become versions of one member;
    ``"content"`` hashes all attributes, so they become another member.  A missing natural key gives the
    unknown member.
    """
    if key_of not in ("natural", "content"):
        raise ValueError(f"key_of must be 'natural' or 'content', not {key_of!r}")
    hashed = natural_key if key_of == "natural" else attributes
    rows = source.groupBy(*attributes).agg(F.max(INGEST_TS).alias(SOURCE_INGEST_TS))
    rows = rows.withColumn(key, F.when(_all_null(natural_key), UNKNOWN_KEY).otherwise(member_key(hashed)))
    label = {c: F.when(F.col(key) == UNKNOWN_KEY, UNKNOWN_LABEL).otherwise(F.col(c)) for c in attributes}
    return stamp(rows.withColumns(label).select(key, *attributes, SOURCE_INGEST_TS), batch_ts)


def _all_null(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNull()
    return out


def sales_dimension(name: str, sales: DataFrame, batch_ts: datetime | Column, *, key_of: str = "natural") -> DataFrame:
    """dim_product, dim_store, dim_promo, or the sales part of dim_customer."""
    key, attributes, natural_key = SALES_DIMENSIONS[name]
    return generate_dimension(sales, attributes, natural_key, key, batch_ts, key_of=key_of)


# Storage column: the hash of all attributes, which tells the rows of a stored partial aggregate apart.
MEMBER_HASH = "member_hash"


def member_rows(name: str) -> TableSpec:
    """The stored partial aggregate of a sales dimension: distinct attributes and when a source row had them last."""
    key, attributes, _ = SALES_DIMENSIONS[name]
    columns = dict.fromkeys((MEMBER_HASH, key, *attributes), "string") | {SOURCE_INGEST_TS: "timestamp", INGEST_TS: "timestamp"}
    return TableSpec(f"{name}_members", GOLD, schema_of(columns), SaveMode.MERGE, (MEMBER_HASH,), version_column=SOURCE_INGEST_TS)


def customer_dimension(
    sales: DataFrame,
    contacts: DataFrame | None,
    batch_ts: datetime | Column,
    *,
    key_of: str = "natural",
    unique: bool = False,
    dedupe_contacts: bool = True,
) -> DataFrame:
    """Latest attributes per customer, enriched with contact columns the declared schema does not have.

    Two names in one batch are both kept unless ``unique``; several contacts of a customer multiply rows
    unless ``dedupe_contacts``.
    """
    rows = sales_dimension("dim_customer", sales, batch_ts, key_of=key_of)
    rows = latest_per_key(rows, ["customer_id"], SOURCE_INGEST_TS, unique=unique)
    if contacts is None:
        return rows
    newest = ["updated_at", "contact_id"] if dedupe_contacts else None
    wanted = contacts.select("customer_id", *CONTACT_COLUMNS, "updated_at")
    return enrich_left(rows, wanted, ["customer_id"], dedupe_right=newest).drop("updated_at")


def station_dimension(info_a: DataFrame, info_b: DataFrame, batch_ts: datetime | Column) -> DataFrame:
    """Current stations of both sources in one shape; attributes a source lacks are NULL."""
    text = F.lit(None).cast("string")
    a = current_only(info_a).select(
        F.col("stationcode").cast("string").alias("station_id"),
        F.lower("name").alias("station_name"),
        "capacity", "longitude", "latitude", "station_opening_hours",
        text.alias("address"),
        F.col(INGEST_TS).alias(SOURCE_INGEST_TS),
    )
    b = current_only(info_b).select(
        F.col("station_id").cast("string").alias("station_id"),
        F.lower("name").alias("station_name"),
        "capacity",
        F.col("lon").alias("longitude"),
        F.col("lat").alias("latitude"),
        text.alias("station_opening_hours"),
        F.lower("address").alias("address"),
        F.col(INGEST_TS).alias(SOURCE_INGEST_TS),
    )
    both = conformed_union({SOURCE_A: a, SOURCE_B: b}, "station_source", ["station_source", *a.columns])
    both = both.withColumn("station_key", surrogate_key(["station_source", "station_id"]))
    return conform(stamp(both, batch_ts), DIM_BIKE_STATION.schema)


def date_dimension(
    spark: SparkSession, start: date, end: date, batch_ts: datetime, weekend_days: Iterable[int] = WEEKEND_DAYS
) -> DataFrame:
    """One row per day, both ends included."""
    days = spark.range((end - start).days + 1)
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    return stamp(days.select(*calendar_columns(day, weekend_days)), batch_ts)


def calendar_of(
    df: DataFrame, day: str, batch_ts: datetime | Column, weekend_days: Iterable[int] = WEEKEND_DAYS
) -> DataFrame:
    """The date dimension covering every date of a table: its bounds are one aggregate away."""
    bounds = df.agg(F.min(day).cast("date").alias("low"), F.max(day).cast("date").alias("high"))
    days = bounds.select(F.explode(F.sequence("low", "high")).alias("d"))
    return stamp(days.select(*calendar_columns(F.col("d"), weekend_days)), batch_ts)


SALES_DIMENSION_TABLES = {"dim_product": DIM_PRODUCT, "dim_store": DIM_STORE, "dim_promo": DIM_PROMO}


def dimension_model(name: str, key_of: str = "natural") -> Model:
    """Model of a sales dimension; its generator takes the cleaned sales table and the batch timestamp."""
    return Model(SALES_DIMENSION_TABLES[name], lambda sales, batch_ts: sales_dimension(name, sales, batch_ts, key_of=key_of))


CUSTOMER_MODEL = Model(DIM_CUSTOMER, customer_dimension)
STATION_MODEL = Model(DIM_BIKE_STATION, station_dimension)
DATE_MODEL = Model(DIM_DATE, date_dimension)
