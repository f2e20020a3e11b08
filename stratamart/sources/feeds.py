"""JSON sources: paged record documents and station feeds, read from the folder they were landed in.

A path is a folder, a file, a glob pattern or a list of those.  One that matches nothing yet is an empty source.  Documents
that are not valid JSON never fail a load; `malformed_documents` lists them, and with ``errors`` a pipeline keeps them, and
values that do not fit, in its quarantine table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.scalars import joined_text
from stratamart.operators.conform import ROW_ERRORS, conform, drop_null_keys, error_list, misfits, row_error
from stratamart.sources.files import matching_paths
from stratamart.sources.tables import empty_frame, scratch_dir, write_files

CORRUPT = "_corrupt_record"


def _as_text(data_type: T.DataType) -> T.DataType:
    """The type with its numbers as text: sources quote some of them, and a quoted number read as a number is lost."""
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_as_text(data_type.elementType))
    return T.StringType() if isinstance(data_type, T.NumericType) else data_type


def page_schema(record: T.StructType) -> T.StructType:
    """One page document: ``{"results": [record, ...]}``, numbers as text."""
    return T.StructType().add("results", T.ArrayType(_as_text(record))).add(CORRUPT, T.StringType())


def _landed(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The given paths and patterns that match something."""
    return [p for p in ([path] if isinstance(path, str) else path) if matching_paths(spark, p)]


def feed_schema(station: dict[str, T.DataType]) -> T.StructType:
    """One feed document: ``{"last_updated": n, "data": {"stations": [...]}}``.

    Numbers are declared as text: feeds quote some of them, and a quoted number read as a number is lost.
    """
    fields = T.StructType()
    for name, data_type in station.items():
        fields = fields.add(name, data_type)
    data = T.StructType().add("stations", T.ArrayType(fields))
    return T.StructType().add("last_updated", T.StringType()).add("data", data).add(CORRUPT, T.StringType())


def _documents(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool) -> DataFrame:
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", multi_line).json(path)


def paged_records(
    spark: SparkSession,
    path: str | list[str],
    record: T.StructType,
    *,
    where: str | None = None,
    select: list[str] | None = None,
    order_by: list[str] | None = None,
    multi_line: bool = False,
    errors: bool = False,
) -> DataFrame:
    """All records of the landed pages; filter, projection and order are ordinary Spark expressions.

    A number may come quoted; text that is none becomes NULL.  ``errors`` adds the column ROW_ERRORS, which lists such
    text, and a row without values for each document that is not valid JSON.

    ``multi_line`` for one document per file, otherwise one document per line (which splits).
    """
    if landed := _landed(spark, path):
        records = _documents(spark, landed, page_schema(record), multi_line)
        if errors:
            records = _with_errors(records, F.col("results"), F.col("results"), record)
        else:
            records = conform(records.select(F.inline("results")), record, lenient=True)
    else:
        records = _no_records(spark, record, errors)
    if where:
        records = records.filter(F.expr(where))
    if select:
        records = records.selectExpr(*select)
    if order_by:
        records = records.orderBy(*[F.expr(o[:-5]).desc() if o.lower().endswith(" desc") else F.expr(o)
                                    for o in order_by])
    return records


def _no_records(spark: SparkSession, schema: T.StructType, errors: bool) -> DataFrame:
    none = empty_frame(spark, schema)
    return none.withColumn(ROW_ERRORS, error_list([])) if errors else none


def _with_errors(documents: DataFrame, whole: Column, records: Column, target: T.StructType) -> DataFrame:
    """The records of documents in the target schema with their errors; a broken document is one rejected row."""
    broken = F.col(CORRUPT).isNotNull() & whole.isNull()
    found = documents.where(broken | (F.size(F.coalesce(records, F.array())) > 0)).select(
        broken.alias("__broken"), F.when(broken, F.col(CORRUPT)).alias("__document"), F.inline_outer(records))
    columns = [f for f in found.schema.fields if not f.name.startswith("__")]
    listed = error_list([row_error(F.col("__broken"), "", F.col("__document"), "malformed document", True),
                         *misfits(T.StructType(columns), target)])
    return conform(found.withColumn(ROW_ERRORS, listed).drop("__broken", "__document"), target, keep_extra=True, lenient=True).select(
        *target.names, ROW_ERRORS)


# Up to this many rows before the end of a page, every task hands on its first ones and one task merges them.
DEEP_PAGE = 100_000


def page_of(df: DataFrame, order_by: list, offset: int, limit: int, *, deep: int = DEEP_PAGE) -> DataFrame:
    """One page in a total order.

    Of a page near the start only offset + limit rows leave each task.  For a deep one the rows are stored in ranges of the
    order; the sizes of the ranges, one number for each, tell which of them hold the page, and only those are read and
    sorted.
    """
    if offset + limit <= deep:
        return df.orderBy(*order_by).offset(offset).limit(limit)
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    # Ranges of about the size that a task takes for a shallow page, two of them at least.
    ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(ranges, *order_by).withColumn("__range", F.spark_partition_id())
    write_files(ranged, path, partition_by=["__range"])
    stored = spark.read.schema(ranged.schema).parquet(path)
    sizes = dict(stored.groupBy("__range").count().collect())
    before, wanted, skipped = 0, [], 0
    for number in sorted(sizes):
        if before + sizes[number] <= offset:
            skipped += sizes[number]
        elif before < offset + limit:
            wanted.append(number)
        before += sizes[number]
    return stored.filter(F.col("__range").isin(wanted)).drop("__range").orderBy(*order_by).offset(offset - skipped).limit(limit)


def malformed_documents(spark: SparkSession, path: str | list[str], record: T.StructType, multi_line: bool = False) -> DataFrame:
    """Text and file of every page document that is not valid JSON."""
    landed = _landed(spark, path)
    if not landed:
        return empty_frame(spark, T.StructType().add("document", T.StringType()).add("file", T.StringType()))
    pages = _documents(spark, landed, page_schema(record), multi_line)
    broken = pages.filter(F.col(CORRUPT).isNotNull() & F.col("results").isNull())
    return broken.select(F.col(CORRUPT).alias("document"), F.col("_metadata.file_path").alias("file"))


# The fields of the two station feeds.
INFO_FIELDS = {
    "station_id": T.StringType(), "name": T.StringType(), "lat": T.StringType(), "lon": T.StringType(),
    "address": T.StringType(), "rental_methods": T.ArrayType(T.StringType()), "capacity": T.StringType(),
}
STATUS_FIELDS = {
    c: T.StringType() for c in (
        "station_id", "num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
        "is_installed", "is_renting", "is_returning", "last_reported",
    )
}


def station_feed(
    spark: SparkSession, path: str | list[str], station: dict[str, T.DataType], target: T.StructType, *, multi_line: bool = False,
    errors: bool = False,
) -> DataFrame:
    """Stations of the landed feed documents, one row each, carrying their document's ``last_updated``.

    Text that does not fit its declared number type becomes NULL; rows without ``station_id`` are dropped.  With ``errors``
    they stay, and the column ROW_ERRORS says what is wrong with each row, see `paged_records`.
    """
    landed = _landed(spark, path)
    if not landed:
        return _no_records(spark, target, errors)
    documents = _documents(spark, landed, feed_schema(station), multi_line)
    if errors:
        stations = F.transform("data.stations", lambda s: F.struct(F.col("last_updated"), *[
            (joined_text(s[n]) if isinstance(t, T.ArrayType) else s[n]).alias(n) for n, t in station.items()]))
        return _with_errors(documents, F.col("data"), stations, target)
    rows = documents.select("last_updated", F.explode("data.stations").alias("station"))
    rows = rows.select("last_updated", "station.*")
    lists = [n for n, t in station.items() if isinstance(t, T.ArrayType)]
    rows = rows.withColumns({c: joined_text(F.col(c)) for c in lists})
    return drop_null_keys(conform(rows, target, lenient=True), ["station_id"])
