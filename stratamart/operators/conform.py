"""Bring a frame to a declared shape: projection, casts, null keys, sanity bounds, schema evolution."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.scalars import epoch_timestamp, flag, utc_literal
from stratamart.spec import INGEST_TS, SCD_CURRENT

# Nothing recorded by a sensor or a shop system is older than this.
SANITY_FLOOR = "1900-01-01 00:00:00"


def conform(df: DataFrame, schema: T.StructType, *, keep_extra: bool = False, lenient: bool = False) -> DataFrame:
    """Declared columns in declared order and type; absent ones are typed NULLs.

    ``lenient`` turns values that do not fit the type into NULL, otherwise they fail the job.
    ``keep_extra`` carries undeclared columns along, after the declared ones, and undeclared fields of structs (schema
    evolution).  Fields of structs, also inside arrays and maps, are matched by name like columns.
    """
    present = {f.name: f.dataType for f in df.schema.fields}

    def one(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        have = present[field.name]
        want = with_extra_fields(field.dataType, have) if keep_extra else field.dataType
        return as_type(F.col(field.name), have, want, lenient).alias(field.name)

    declared = [one(f) for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in schema.names] if keep_extra else []
    return df.select(*declared, *extra)


def as_type(column: Column, have: T.DataType, want: T.DataType, lenient: bool = False) -> Column:
    """A cast that matches the fields of structs by name: absent ones are typed NULLs, others than the wanted ones go."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [
            (as_type(column[f.name], known[f.name], f.dataType, lenient) if f.name in known else F.lit(None).cast(f.dataType))
            .alias(f.name) for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType) and _nested(have):
        return F.transform(column, lambda x: as_type(x, have.elementType, want.elementType, lenient))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and _nested(have):
        return F.transform_values(column, lambda _, x: as_type(x, have.valueType, want.valueType, lenient))
    return column.try_cast(want) if lenient else column.cast(want)


def _nested(data_type: T.DataType) -> bool:
    """Whether there is a struct in it."""
    if isinstance(data_type, T.ArrayType):
        return _nested(data_type.elementType)
    return _nested(data_type.valueType) if isinstance(data_type, T.MapType) else isinstance(data_type, T.StructType)


def with_extra_fields(declared: T.DataType, have: T.DataType) -> T.DataType:
    """The declared type, with the fields that structs of a frame have beyond it."""
    if isinstance(declared, T.StructType) and isinstance(have, T.StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [T.StructField(f.name, with_extra_fields(f.dataType, known[f.name]) if f.name in known else f.dataType)
                  for f in declared.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in have.fields if f.name not in declared.names])
    if isinstance(declared, T.ArrayType) and isinstance(have, T.ArrayType):
        return T.ArrayType(with_extra_fields(declared.elementType, have.elementType))
    if isinstance(declared, T.MapType) and isinstance(have, T.MapType):
        return T.MapType(declared.keyType, with_extra_fields(declared.valueType, have.valueType))
    return declared


# What is wrong with a source row: the column, its text, why, and whether the row is left out for it.
ROW_ERRORS = "row_errors"
ERROR_TYPE = "array<struct<column: string, value: string, reason: string, rejected: boolean>>"


def row_error(when: Column, column: str, value: Column, reason: str, rejected: bool) -> Column:
    return F.when(when, F.struct(F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(reason).alias("reason"),
                                 F.lit(rejected).alias("rejected")))


def error_list(errors: Iterable[Column]) -> Column:
    """The errors that apply, as one array; built while the row is read, so nothing is looked at twice."""
    found = list(errors)
    if not found:
        return F.array().cast(ERROR_TYPE)
    return F.filter(F.array(*found), lambda e: e.isNotNull()).cast(ERROR_TYPE)


def misfits(have: T.StructType, want: T.StructType, parent: Column | None = None, prefix: str = "") -> list[Column]:
    """For each column, or field of a struct, an error where its text does not fit the wanted type."""
    out, wanted = [], {f.name: f.dataType for f in want.fields}
    for f in have.fields:
        column = F.col(f.name) if parent is None else parent[f.name]
        target = wanted.get(f.name)
        if isinstance(f.dataType, T.StructType) and isinstance(target, T.StructType):
            out += misfits(f.dataType, target, column, f"{prefix}{f.name}.")
        elif target is not None and target != f.dataType and isinstance(f.dataType, T.AtomicType):
            lost = column.isNotNull() & column.try_cast(target).isNull()
            out.append(row_error(lost, f"{prefix}{f.name}", column, f"does not fit {target.simpleString()}", False))
    return out


def missing_keys(key: Iterable[str]) -> list[Column]:
    return [row_error(F.col(c).isNull(), c, F.lit(None), "missing key", True) for c in key]


def implausible(columns: Iterable[str], seconds: bool = False, floor: str = SANITY_FLOOR) -> list[Column]:
    """Times that `not_before` will drop; ``seconds`` for epoch seconds."""
    out = []
    for c in columns:
        time = epoch_timestamp(F.col(c)) if seconds else F.col(c)
        fits = F.coalesce(time >= F.lit(floor).cast("timestamp"), F.lit(False))
        out.append(row_error(~fits, c, F.col(c), "implausible time", False))
    return out


def stamp(df: DataFrame, batch_ts: datetime | Column, column: str = INGEST_TS) -> DataFrame:
    """Add the batch timestamp to every row."""
    value = batch_ts.cast("timestamp") if isinstance(batch_ts, Column) else utc_literal(batch_ts)
    return df.withColumn(column, value)


def flatten_struct(df: DataFrame, column: str, fields: Mapping[str, str], data_type: str = "double") -> DataFrame:
    """Lift ``column.field`` to top-level columns and drop the struct; a frame without it passes unchanged."""
    if column not in df.columns:
        return df
    lifted = {out: F.col(f"{column}.{name}").cast(data_type) for name, out in fields.items()}
    return df.withColumns(lifted).drop(column)


def decode_flags(df: DataFrame, columns: Iterable[str], yes: str | int) -> DataFrame:
    """Text or number flags to booleans, for those of ``columns`` that are present."""
    return df.withColumns({c: flag(F.col(c), yes) for c in columns if c in df.columns})


def drop_null_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    for c in key:
        df = df.filter(F.col(c).isNotNull())
    return df


def not_before(df: DataFrame, columns: Iterable[str], floor: str = SANITY_FLOOR) -> DataFrame:
    """Keep rows whose timestamps are plausible; NULLs are dropped too."""
    for c in columns:
        df = df.filter(F.col(c) >= F.lit(floor).cast("timestamp"))
    return df


def current_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(SCD_CURRENT))


# The type changes that lose nothing and that stored files serve as they are, narrow type to wider
# ones.  A date is no timestamp in Parquet.
_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType),
    T.ShortType: (T.IntegerType, T.LongType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


class IncompatibleSchema(ValueError):
    """A column changed to a type that cannot hold the values already stored."""


def _fits(narrow: T.DataType, wide: T.DataType) -> bool:
    if narrow == wide or isinstance(narrow, T.NullType):
        return True
    if isinstance(narrow, T.DecimalType) and isinstance(wide, T.DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    return type(wide) in _WIDER.get(type(narrow), ())


def merged_type(old: T.DataType, new: T.DataType, name: str) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged_schema(old, new, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType, f"{name}[]"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, merged_type(old.valueType, new.valueType, f"{name}[]"))
    if _fits(new, old):
        return old
    if _fits(old, new):
        return new
    raise IncompatibleSchema(f"column {name}: {old.simpleString()} cannot become {new.simpleString()}")


def merged_schema(stored: T.StructType, incoming: T.StructType, prefix: str = "") -> T.StructType:
    """Stored columns, widened where needed, then the incoming new ones.

    An incoming type that is narrower than the stored one is read as the stored type; a type that neither
    fits nor is fitted is an error.  Structs, also those inside arrays and maps, are merged in the same way.
    """
    by_name = {f.name: f for f in incoming.fields}
    fields = []
    for old in stored.fields:
        new = by_name.pop(old.name, None)
        fields.append(T.StructField(old.name, old.dataType if new is None else merged_type(old.dataType, new.dataType, prefix + old.name)))
    added = [f for f in incoming.fields if f.name in by_name]
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in added])


def evolve(stored: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames in their merged schema: new columns read NULL in old rows, missing ones NULL in new rows."""
    old, new = stored.schema, incoming.schema
    if [(f.name, f.dataType) for f in old.fields] == [(f.name, f.dataType) for f in new.fields]:
        return stored, incoming
    schema = merged_schema(old, new)
    return conform(stored, schema), conform(incoming, schema)
