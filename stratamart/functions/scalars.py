"""Scalar expressions used by the pipelines and models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Spark counts Sunday as day 1 of the week and Saturday as day 7.
WEEKEND_DAYS = (1, 7)


def flag(column: Column, yes: str | int) -> Column:
    """Decode a text or number flag; NULL stays NULL."""
    return column == F.lit(yes)


EPOCH = datetime(1970, 1, 1)
# Seconds that Spark timestamps can hold: years 1 to 9999.
EPOCH_SECONDS = (-62_135_596_800, 253_402_300_799)


def utc_micros(at: datetime) -> int:
    """Microseconds since 1970.  A datetime without zone is UTC, whatever the zone of the driver's machine."""
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return (at - EPOCH) // timedelta(microseconds=1)


def utc_literal(at: datetime) -> Column:
    """A timestamp literal, see `utc_micros`."""
    return F.timestamp_micros(F.lit(utc_micros(at)))


def utc_datetime(micros: int | None) -> datetime | None:
    """The way back, for values collected as ``unix_micros``; no machine's zone takes part."""
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds to timestamp; numbers outside the years 1 to 9999 become NULL instead of failing the job."""
    return F.when(seconds.between(*EPOCH_SECONDS), F.timestamp_seconds(seconds))


def parsed_timestamp(text: Column) -> Column:
    """Text to timestamp; malformed text becomes NULL instead of failing the job."""
    return F.try_to_timestamp(text)


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def calendar_columns(day: Column, weekend_days: Iterable[int] = WEEKEND_DAYS) -> list[Column]:
    """The attributes of a date dimension."""
    return [
        date_key(day).alias("date_key"),
        day.alias("date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.quarter(day).alias("quarter"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofweek(day).isin(*weekend_days).alias("is_weekend"),
    ]


def decoded(column: Column, values: Mapping[str, str | None], default: str | None = None) -> Column:
    """CASE column WHEN .. THEN .. ELSE default END."""
    out = None
    for key, value in values.items():
        hit, result = column == F.lit(key), F.lit(value)
        out = F.when(hit, result) if out is None else out.when(hit, result)
    fallback = F.lit(default)
    return fallback if out is None else out.otherwise(fallback)


def trailing_digits(text: Column) -> Column:
    """'CUST12' -> '12'."""
    return F.regexp_extract(text, r"(\d+)$", 1)


def zero_padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def cyclic_pick(values: Iterable[str], index: Column) -> Column:
    """values[index % n]."""
    items = list(values)
    return F.element_at(F.array(*[F.lit(v) for v in items]), (index % len(items) + 1).cast("int"))


def joined_text(items: Column) -> Column:
    """Array to comma-joined text; a missing array gives ''."""
    return F.array_join(F.coalesce(items, F.array().cast("array<string>")), ",")


def money(column: Column) -> Column:
    return column.cast(DecimalType(18, 2))


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole to two digits; NULL where whole is zero."""
    return F.round(F.try_divide(F.lit(100) * part, whole), 2).cast(DecimalType(18, 2))
