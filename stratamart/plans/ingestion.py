"""Raw and cleaned tables of the six sources, and the functions that clean them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.scalars import epoch_timestamp, utc_literal
from stratamart.operators.conform import (
    conform, decode_flags, drop_null_keys, flatten_struct, implausible, missing_keys, not_before,
)
from stratamart.sources.feeds import INFO_FIELDS, STATUS_FIELDS, paged_records, station_feed
from stratamart.spec import INGEST_TS, Pipeline, SaveMode, TableSpec, schema_of, with_ingest_ts

RAW, CLEAN, GOLD = "bronze", "silver", "gold"
MONEY = T.DecimalType(10, 2)
# Order numbers grow, so a batch falls into the last blocks of the tables keyed by them.
ORDERS_PER_BLOCK = 50_000_000
DAY = 86_400
GEO = T.StructType().add("lon", "double").add("lat", "double")

# The declared columns of the sources.
SALES = schema_of({
    "order_id": "long", "order_line": "integer", "order_date": "date", "customer_id": "string",
    "customer_name": "string", "product_id": "string", "product_name": "string", "category": "string",
    "brand": "string", "store_id": "string", "store_name": "string", "city": "string", "state": "string",
    "quantity": "integer", "unit_price": MONEY, "discount": MONEY, "cost": MONEY, "promo_code": "string",
}, required=("order_id", "order_line"))

CONTACTS = schema_of({
    "contact_id": "string", "customer_id": "string", "first_name": "string", "last_name": "string",
    "email": "string", "phone": "string", "address": "string", "city": "string", "state": "string",
    "zip_code": "string", "country": "string", "job_title": "string", "created_at": "timestamp",
    "updated_at": "timestamp",
}, required=("contact_id",))

# Station source A: paged records, text flags, coordinates in a struct.
INFO_A_SOURCE = schema_of({
    "stationcode": "string", "name": "string", "capacity": "integer", "coordonnees_geo": GEO,
    "station_opening_hours": "string",
})
INFO_A = schema_of({
    "stationcode": "string", "name": "string", "capacity": "integer", "station_opening_hours": "string",
    "longitude": "double", "latitude": "double",
})
STATUS_A_SOURCE = schema_of({
    "stationcode": "string", "name": "string", "is_installed": "string", "numdocksavailable": "integer",
    "numbikesavailable": "integer", "mechanical": "integer", "ebike": "integer", "is_renting": "string",
    "is_returning": "string", "duedate": "string", "coordonnees_geo": GEO,
    "nom_arrondissement_communes": "string", "code_insee_commune": "string", "station_opening_hours": "string",
    "timestamp": "timestamp",
})
STATUS_A = schema_of({
    "stationcode": "string", "name": "string", "is_installed": "boolean", "numdocksavailable": "integer",
    "numbikesavailable": "integer", "mechanical": "integer", "ebike": "integer", "is_renting": "boolean",
    "is_returning": "boolean", "duedate": "string", "longitude": "double", "latitude": "double",
    "nom_arrondissement_communes": "string", "code_insee_commune": "string", "station_opening_hours": "string",
    "timestamp": "timestamp",
})

# Station source B: feed documents, 1/0 flags, epoch seconds.
INFO_B_SOURCE = schema_of({
    "station_id": "integer", "name": "string", "lat": "double", "lon": "double", "address": "string",
    "rental_methods": "string", "capacity": "integer", "last_updated": "long",
})
INFO_B = schema_of({**{f.name: f.dataType for f in INFO_B_SOURCE.fields}, "last_updated": "timestamp"})
STATUS_B_SOURCE = schema_of({
    "station_id": "integer", "last_updated": "long", "num_bikes_available": "integer",
    "num_bikes_disabled": "integer", "num_docks_available": "integer", "num_docks_disabled": "integer",
    "is_installed": "integer", "is_renting": "integer", "is_returning": "integer", "last_reported": "long",
})
STATUS_B = schema_of({
    **{f.name: f.dataType for f in STATUS_B_SOURCE.fields}, "last_updated": "timestamp",
    "is_installed": "boolean", "is_renting": "boolean", "is_returning": "boolean", "last_reported": "timestamp",
})
FLAGS = ("is_installed", "is_renting", "is_returning")
GEO_COLUMNS = {"lon": "longitude", "lat": "latitude"}


def info_a_source(spark: SparkSession, path: str, **options) -> DataFrame:
    rows = paged_records(spark, path, INFO_A_SOURCE, **options)
    return conform(drop_null_keys(rows, ["stationcode"]), INFO_A_SOURCE)


def status_a_source(spark: SparkSession, path: str, batch_ts: datetime, **options) -> DataFrame:
    """Records of one poll, stamped with the time of the call.

    Not sorted: a table has no order, and the few values of the service's sort column would be few tasks.  With ``errors``
    records without key stay, and are left to the pipeline's checks.
    """
    rows = paged_records(spark, path, STATUS_A_SOURCE, **options)
    if not options.get("errors"):
        rows = drop_null_keys(rows, ["stationcode"])
    return rows.withColumn("timestamp", utc_literal(batch_ts)).select(*STATUS_A_SOURCE.names, *rows.columns[len(STATUS_A_SOURCE):])


def info_b_source(spark: SparkSession, path: str, **options) -> DataFrame:
    return station_feed(spark, path, INFO_FIELDS, INFO_B_SOURCE, **options)


def status_b_source(spark: SparkSession, path: str, **options) -> DataFrame:
    return station_feed(spark, path, STATUS_FIELDS, STATUS_B_SOURCE, **options)


def _clean(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns, and the batch timestamp if the frame has been stamped already."""
    return conform(df, with_ingest_ts(schema) if INGEST_TS in df.columns else schema)


def clean_info_a(df: DataFrame) -> DataFrame:
    return _clean(flatten_struct(df, "coordonnees_geo", GEO_COLUMNS), INFO_A)


def clean_status_a(df: DataFrame) -> DataFrame:
    flat = flatten_struct(df, "coordonnees_geo", GEO_COLUMNS)
    return _clean(decode_flags(flat, FLAGS, "OUI"), STATUS_A)


def _epochs(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Epoch seconds to timestamps; rows with missing or implausible ones are dropped."""
    return not_before(df.withColumns({c: epoch_timestamp(F.col(c)) for c in columns}), columns)


def clean_info_b(df: DataFrame) -> DataFrame:
    return _clean(_epochs(df, ("last_updated",)), INFO_B)


def clean_status_b(df: DataFrame) -> DataFrame:
    return _clean(_epochs(decode_flags(df, FLAGS, 1), ("last_updated", "last_reported")), STATUS_B)


def _raw(name: str, schema: T.StructType, key: tuple[str, ...], description: str) -> TableSpec:
    return TableSpec(name, RAW, with_ingest_ts(schema), SaveMode.APPEND, key, partition_by=(INGEST_TS,),
                     description=description)


RAW_SALES = _raw("sales_transactions", SALES, ("order_id", "order_line"), "Raw sales lines")
RAW_CONTACTS = _raw("contacts", CONTACTS, ("contact_id",), "Raw customer contacts")
RAW_INFO_A = _raw("station_info_a", INFO_A_SOURCE, ("stationcode",), "Raw station attributes, source A")
RAW_STATUS_A = _raw("station_status_a", STATUS_A_SOURCE, ("stationcode", "timestamp"), "Raw station states, source A")
RAW_INFO_B = _raw("station_info_b", INFO_B_SOURCE, ("station_id", "last_updated"), "Raw station attributes, source B")
RAW_STATUS_B = _raw("station_status_b", STATUS_B_SOURCE, ("station_id", "last_updated"), "Raw station states, source B")

CLEAN_SALES = TableSpec("sales_transactions", CLEAN, with_ingest_ts(SALES), SaveMode.MERGE, ("order_id", "order_line"),
                        version_column=INGEST_TS, key_blocks=("order_id", ORDERS_PER_BLOCK),
                        description="One row per sales line")
CLEAN_CONTACTS = TableSpec("contacts", CLEAN, with_ingest_ts(CONTACTS), SaveMode.MERGE, ("contact_id",),
                           version_column=INGEST_TS, description="One row per contact")
CLEAN_INFO_A = TableSpec(
    "station_info_a", CLEAN, with_ingest_ts(INFO_A), SaveMode.MERGE_SCD2, ("stationcode",),
    change_columns=("name", "capacity", "longitude", "latitude", "station_opening_hours"),
    description="Station attributes with history, source A",
)
CLEAN_STATUS_A = TableSpec("station_status_a", CLEAN, with_ingest_ts(STATUS_A), SaveMode.MERGE,
                           ("stationcode", "timestamp"), version_column=INGEST_TS, key_blocks=("timestamp", DAY),
                           description="One row per station and poll, source A")
CLEAN_INFO_B = TableSpec(
    "station_info_b", CLEAN, with_ingest_ts(INFO_B), SaveMode.MERGE_SCD2, ("station_id",),
    change_columns=("name", "lat", "lon", "address", "rental_methods", "capacity"),
    description="Station attributes with history, source B",
)
CLEAN_STATUS_B = TableSpec("station_status_b", CLEAN, with_ingest_ts(STATUS_B), SaveMode.MERGE,
                           ("station_id", "last_updated"), version_column=INGEST_TS, key_blocks=("last_updated", DAY),
                           description="One row per station and feed document, source B")

Source = Callable[[SparkSession], DataFrame]


def _keyed(key: str, *epochs: str) -> Callable[[], list[Column]]:
    """Rows without key are rejected; rows whose epoch seconds cleaning will drop are kept in the raw table and listed."""
    return lambda: [*missing_keys([key]), *implausible(epochs, seconds=True)]


def sales_pipeline(source: Source) -> Pipeline:
    return Pipeline("sales_transactions", RAW_SALES, CLEAN_SALES, source)


def contacts_pipeline(source: Source) -> Pipeline:
    return Pipeline("contacts", RAW_CONTACTS, CLEAN_CONTACTS, source)


def info_a_pipeline(source: Source) -> Pipeline:
    return Pipeline("station_info_a", RAW_INFO_A, CLEAN_INFO_A, source, clean_info_a, checks=_keyed("stationcode"))


def status_a_pipeline(source: Source) -> Pipeline:
    return Pipeline("station_status_a", RAW_STATUS_A, CLEAN_STATUS_A, source, clean_status_a, checks=_keyed("stationcode"))


def info_b_pipeline(source: Source) -> Pipeline:
    return Pipeline("station_info_b", RAW_INFO_B, CLEAN_INFO_B, source, clean_info_b, checks=_keyed("station_id", "last_updated"))


def status_b_pipeline(source: Source) -> Pipeline:
    return Pipeline("station_status_b", RAW_STATUS_B, CLEAN_STATUS_B, source, clean_status_b,
                    checks=_keyed("station_id", "last_updated", "last_reported"))
