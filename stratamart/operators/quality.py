"""Key and reference checks, and the findings table they are logged to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.keys import packed, surrogate_key
from stratamart.functions.scalars import utc_literal
from stratamart.operators.conform import current_only
from stratamart.operators.skew import spread_join
from stratamart.session import freed_shuffles
from stratamart.spec import SCD_CURRENT, SaveMode, TableSpec

FINDING_COLUMNS = ("table_name", "check_name", "columns", "violations", "ingest_ts")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with their row counts (counted map-side first)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def orphans(fact: DataFrame, dimension: DataFrame, columns: Sequence[str], ref_columns: Sequence[str],
            *, hot_rows: int | None = None) -> DataFrame:
    """Fact rows whose (non-null) reference has no member.

    A fact has few distinct references: they are reduced before the join, and the join that fetches the
    offending rows splits hot references.
    """
    refs = fact.select(*columns).filter(~_any_null(columns)).distinct()
    members = dimension.select(*[F.col(r).alias(c) for c, r in zip(columns, ref_columns)])
    missing = refs.join(members, list(columns), "left_anti")
    return spread_join(fact, missing, columns, "left_semi", hot_rows=hot_rows)


def orphan_count(fact: DataFrame, dimension: DataFrame, columns: Sequence[str], ref_columns: Sequence[str]) -> DataFrame:
    """One row with the number of orphans; references are counted before the join, rows never shuffle."""
    refs = fact.filter(~_any_null(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    members = dimension.select(*[F.col(r).alias(c) for c, r in zip(columns, ref_columns)])
    return refs.join(members, list(columns), "left_anti").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))


def orphan_counts(fact: DataFrame, references: Sequence[tuple[str, Sequence[str], DataFrame, Sequence[str]]]) -> DataFrame:
    """Orphans of several references, given as (label, columns, dimension, its columns), in one pass: (label, violations).

    Each fact row becomes a (label, key) pair for each reference; equal pairs are counted before they are shuffled, and one
    join with the members of all dimensions leaves those without one.
    """
    pairs, members = [], None
    for label, columns, dimension, ref_columns in references:
        # The text of a single column tells its keys apart; hashing it would cost time for every row.
        one = packed(F.col(columns[0]).cast("string") if len(columns) == 1 else surrogate_key(columns))
        key = F.when(~_any_null(columns), one)
        pairs.append(F.struct(F.lit(label).alias("label"), key.alias("key")))
        as_in_fact = [F.col(r).try_cast(fact.schema[c].dataType).alias(c) for c, r in zip(columns, ref_columns)]
        known = dimension.select(*as_in_fact).select(F.lit(label).alias("label"), one.alias("key"))
        members = known if members is None else members.unionByName(known)
    found = fact.select(F.inline(F.array(*pairs))).filter(F.col("key").isNotNull()).groupBy("label", "key").agg(
        F.count(F.lit(1)).alias("rows"))
    missing = found.join(members, ["label", "key"], "left_anti").groupBy("label").agg(F.sum("rows").alias("violations"))
    labels = fact.sparkSession.createDataFrame([(r[0],) for r in references], "label string")
    return labels.join(missing, "label", "left").select("label", F.coalesce("violations", F.lit(0)).alias("violations"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs of every listed column in one pass: one row per column."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("columns"), F.col(c).alias("violations")) for c in columns])
    return wide.select(F.inline(pairs))


def _finding(df: DataFrame, table: str, check: str, columns: str | Column, ts: Column) -> DataFrame:
    label = columns if isinstance(columns, Column) else F.lit(columns)
    return df.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), label.alias("columns"),
                     F.col("violations").cast("bigint").alias("violations"), ts.alias("ingest_ts"))


def _counted(found: DataFrame) -> DataFrame:
    """The few rows of a check, counted now, so that its shuffle files are gone before the next one begins."""
    with freed_shuffles(found.sparkSession):
        rows = found.select("*").collect()
    return found.sparkSession.createDataFrame(rows, found.schema)


def check_table(spec: TableSpec, df: DataFrame, references: Mapping[str, DataFrame], batch_ts: datetime) -> DataFrame:
    """Findings of one table: key uniqueness, required columns, and every declared reference.

    Checks without violations are reported with 0.  ``references`` gives the frames the foreign keys name;
    those not given are skipped.  The checks run one after the other, and text keys are shuffled packed.
    """
    ts = utc_literal(batch_ts)
    key = list(spec.primary_key)
    versioned = spec.save_mode is SaveMode.MERGE_SCD2 and SCD_CURRENT in df.columns
    live = current_only(df) if versioned else df
    keys = live.select(*[packed(F.col(c)).alias(c) if df.schema[c].dataType == T.StringType() else c for c in key])
    counted = duplicate_keys(keys, key).agg(F.count(F.lit(1)).alias("violations"))
    found = [_finding(_counted(counted), spec.name, "primary_key", ",".join(key), ts)]
    required = sorted({f.name for f in spec.schema.fields if not f.nullable} | set(key))
    found.append(_finding(_counted(null_counts(df, required)), spec.name, "not_null", F.col("columns"), ts))
    declared = {f"{fk.ref_table}:{','.join(fk.columns)}": fk for fk in spec.foreign_keys if fk.ref_table in references}
    if declared:
        counts = _counted(orphan_counts(
            df, [(label, fk.columns, references[fk.ref_table], fk.ref_columns) for label, fk in declared.items()]))
        label = F.split("label", ":")
        found.append(counts.select(
            F.lit(spec.name).alias("table_name"), F.concat(F.lit("foreign_key:"), label[0]).alias("check_name"),
            label[1].alias("columns"), F.col("violations").cast("bigint").alias("violations"), ts.alias("ingest_ts")))
    return reduce(DataFrame.unionByName, found)
