"""One run of a pipeline or model against stored tables."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.scalars import utc_literal, utc_micros
from stratamart.operators.audit import LoadCounts
from stratamart.operators.conform import ROW_ERRORS, conform, error_list, stamp
from stratamart.sources.files import delete_path, path_exists, write_note
from stratamart.sources.tables import (
    PartitionedTable, Scd2Table, SnapshotTable, append_batch, empty_frame, staged,
)
from stratamart.spec import AUDIT_COUNTS, INGEST_TS, KEY_BLOCK, Model, Pipeline, SaveMode, TableSpec, schema_of

LOAD_AUDIT = TableSpec(
    "load_audit", "operations",
    schema_of({"layer": "string", "table_name": "string", "batch_id": "long", INGEST_TS: "timestamp",
               **dict.fromkeys(AUDIT_COUNTS, "long")}),
    SaveMode.APPEND, ("layer", "table_name", "batch_id"), description="What each load read, wrote and left out",
)


def _layout(spec: TableSpec) -> dict:
    return {"target_file_bytes": spec.target_file_bytes, "compression": spec.compression}


def store_of(spark: SparkSession, spec: TableSpec, root: str) -> SnapshotTable | Scd2Table | PartitionedTable:
    """The stored table of a declaration."""
    if spec.save_mode is SaveMode.MERGE_SCD2:
        return Scd2Table(spark, spec.path(root), spec.schema)
    if spec.key_blocks:
        schema = T.StructType([*spec.schema.fields, T.StructField(KEY_BLOCK, T.LongType())])
        return PartitionedTable(spark, spec.path(root), [KEY_BLOCK], schema, evolving=spec.evolve,
                                follows_key=True, key_blocks=spec.key_blocks)
    if spec.partition_by:
        return PartitionedTable(spark, spec.path(root), spec.partition_by, spec.schema, evolving=spec.evolve,
                                follows_key=spec.partition_follows_key)
    return SnapshotTable(spark, spec.path(root), spec.schema)


def save(spark: SparkSession, spec: TableSpec, root: str, rows: DataFrame, batch_id: int, batch_ts: datetime,
         deletes: DataFrame | None = None, *, writer: str = "batch", consumed: DataFrame | None = None,
         later: DataFrame | None = None, stored: bool = False) -> dict[str, int | None]:
    """Write a batch the way the table declares; repeating a batch leaves the table as it was.  Returns what it counted.

    ``writer`` and ``consumed`` go to the ledger of a partitioned table.  ``later`` says that the batch comes late: the
    rows of batches after it (with their ingest times), between which a type 2 table splices it in.  ``stored`` as in
    `PartitionedTable.merge`.
    """
    counts = LoadCounts()
    if not spec.evolve:
        rows = conform(rows, spec.schema)
    table, key = store_of(spark, spec, root), list(spec.primary_key)
    if spec.save_mode is SaveMode.APPEND:
        table.append(rows, counts=counts, **_layout(spec))
    elif spec.save_mode is SaveMode.MERGE_SCD2:
        order = [c for c in rows.columns if c.endswith(INGEST_TS)]
        if later is None:
            table.apply(rows, key, spec.change_columns, batch_id, batch_ts, order_by=order, overwrite=spec.overwrite_columns,
                        deletes=deletes, layout=_layout(spec), counts=counts)
        else:
            if deletes is not None or spec.overwrite_columns:
                raise ValueError(f"a late batch of {spec.name} can neither delete keys nor refresh columns in place")
            table.splice(rows.withColumn(_AT, utc_literal(batch_ts)), key, spec.change_columns, batch_id, ts=_AT,
                         observed=later.withColumn(_AT, F.col(INGEST_TS)), order_by=order, layout=_layout(spec), counts=counts)
    else:
        options = {"version": spec.version_column, "allow_new_columns": spec.evolve, "counts": counts,
                   "key_range": key[0] if spec.prune_key_range else None, "layout": _layout(spec), "deletes": deletes}
        if isinstance(table, PartitionedTable):
            options |= {"writer": writer, "stored": stored}
        options["consumed"] = consumed
        table.merge(rows, key, batch_id, **options)
    if isinstance(table, SnapshotTable) and spec.keep_versions:
        # Expiring a type 2 table compacts its closed versions, so that is done once in a while.
        slack = SCD2_SLACK * spec.keep_versions if isinstance(table, Scd2Table) else 0
        if len(table.versions()) > spec.keep_versions + slack:
            table.expire(spec.keep_versions)
    return counts.values()


SCD2_SLACK = 3


_AT = "__at"


def land(spark: SparkSession, pipeline: Pipeline, root: str, rows: DataFrame, batch_id: int, batch_ts: datetime, *,
         stored: bool = False) -> None:
    """Append source rows to the raw table, stamped with the batch time.

    Rows with errors, listed by the source or found by the pipeline's checks, go to the quarantine table with what is wrong
    with them; of these the raw table gets those that are not rejected.  ``stored`` says that the source is read from stored
    tables and is the same each time: then only the rows with errors are copied, and the others are written once.
    """
    raw, found = pipeline.bronze, {}
    declared = T.StructType([f for f in raw.schema.fields if f.name != INGEST_TS])
    listed = ROW_ERRORS in rows.columns
    rows = conform(rows, declared, keep_extra=raw.evolve or listed)
    if listed and not raw.evolve:
        rows = rows.select(*declared.names, ROW_ERRORS)
    errors = error_list(pipeline.checks()) if pipeline.checks else None
    if listed:
        known = F.coalesce(ROW_ERRORS, error_list([]))
        # A row that is out already, such as a broken document, is not looked at further.
        out = F.exists(known, lambda e: e["rejected"])
        errors = known if errors is None else F.when(out, known).otherwise(F.concat(known, errors))
    if errors is not None:
        seen, rows = LoadCounts(), rows.withColumn(ROW_ERRORS, errors)
        left_out, with_errors = F.exists(ROW_ERRORS, lambda e: e["rejected"]), F.size(ROW_ERRORS) > 0
        copied = staged(seen.watch(rows.where(with_errors) if stored else rows, rows_with_errors=F.count_if(with_errors),
                                   rows_rejected=F.count_if(left_out)))
        if not stored:
            # Both tables are parts of what was copied, so they fit together whatever the source does meanwhile.
            rows = copied
        found = seen.values()
        quarantine(copied if found["rows_with_errors"] else None, pipeline.name, root, batch_id, batch_ts, spark)
        rows = rows.where(~F.exists(ROW_ERRORS, lambda e: e["rejected"])).drop(ROW_ERRORS)
    landed = stamp(rows, batch_ts)
    counted = save(spark, raw, root, landed, batch_id, batch_ts)
    if found:
        counted |= {"rows_read": counted["rows_read"] + found["rows_rejected"], "rows_rejected": found["rows_rejected"]}
    audit(spark, raw, root, batch_id, batch_ts, counted)


QUARANTINE = TableSpec(
    "quarantine", "operations",
    schema_of({"pipeline": "string", "batch_id": "long", "column": "string", "value": "string", "reason": "string", "rejected": "boolean",
               "record": "string", INGEST_TS: "timestamp"}),
    SaveMode.APPEND, (), partition_by=("pipeline", "batch_id"), description="Source rows with errors, one row for each error",
)


def quarantine(rows: DataFrame | None, pipeline: str, root: str, batch_id: int, batch_ts: datetime, spark: SparkSession) -> None:
    """Store the errors of a batch, each with its whole record, in place of those that a former run of the batch stored."""
    delete_path(spark, f"{QUARANTINE.path(root)}/pipeline={pipeline}/batch_id={batch_id}")
    if rows is None:
        return
    record = F.to_json(F.struct(*[c for c in rows.columns if c != ROW_ERRORS]))
    bad = rows.where(F.size(ROW_ERRORS) > 0).select(F.explode(ROW_ERRORS).alias("e"), record.alias("record"))
    bad = bad.select(F.lit(pipeline).alias("pipeline"), F.lit(batch_id).cast("long").alias("batch_id"), "e.*", "record",
                     utc_literal(batch_ts).alias(INGEST_TS))
    append_batch(bad, QUARANTINE.path(root), QUARANTINE.partition_by)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, QUARANTINE.path(root)):
        return empty_frame(spark, QUARANTINE.schema)
    return spark.read.schema(QUARANTINE.schema).parquet(QUARANTINE.path(root))


def clean(spark: SparkSession, pipeline: Pipeline, root: str, batch_id: int, batch_ts: datetime, *,
          writer: str = "batch") -> None:
    """Clean a landed batch and merge it.  A batch that is older than others of a type 2 table is spliced in."""
    raw = store_of(spark, pipeline.bronze, root).read()
    at = utc_literal(batch_ts)
    rows = pipeline.transform(raw.filter(F.col(INGEST_TS) == at))
    deletes = pipeline.deletes(spark) if pipeline.deletes else None
    later = None
    if pipeline.silver.save_mode is SaveMode.MERGE_SCD2:
        newer = raw.filter(F.col(INGEST_TS) > at)
        later = None if newer.isEmpty() else pipeline.transform(newer)
    counted = save(spark, pipeline.silver, root, rows, batch_id, batch_ts, deletes, writer=writer, later=later, stored=True)
    audit(spark, pipeline.silver, root, batch_id, batch_ts, counted)


def run_pipeline(spark: SparkSession, pipeline: Pipeline, root: str, batch_id: int, batch_ts: datetime, *,
                 stored: bool = False) -> None:
    """Land the source, clean the landed batch, merge it.

    Cleaning reads the landed partition back, so the source is evaluated once and a repeated run works on
    the very rows that were landed.  ``batch_id`` counts arrivals; ``batch_ts`` may be earlier than that of former runs.
    ``stored`` as in `land`.
    """
    land(spark, pipeline, root, pipeline.source(spark), batch_id, batch_ts, stored=stored)
    clean(spark, pipeline, root, batch_id, batch_ts)


def run_model(spark: SparkSession, model: Model, root: str, batch_id: int, batch_ts: datetime, /, *, writer: str = "batch",
              consumed: DataFrame | None = None, stored: bool = False, **inputs) -> None:
    """Generate a gold batch from ``inputs`` and merge it; ``stored`` says that it takes little to generate from stored tables."""
    rows = model.generate(**inputs, batch_ts=batch_ts)
    counted = save(spark, model.table, root, rows, batch_id, batch_ts, writer=writer, consumed=consumed, stored=stored)
    audit(spark, model.table, root, batch_id, batch_ts, counted)


def _audit_path(root: str) -> str:
    return f"{root.rstrip('/')}/{LOAD_AUDIT.layer}/{LOAD_AUDIT.name}"


def audit(spark: SparkSession, spec: TableSpec, root: str, batch_id: int, batch_ts: datetime,
          counted: dict[str, int | None]) -> None:
    """Store the audit row of a load; a repeated load replaces its row."""
    row = {"layer": spec.layer, "table_name": spec.name, "batch_id": batch_id,
           INGEST_TS: utc_micros(batch_ts), **counted}
    write_note(spark, f"{_audit_path(root)}/{spec.layer}.{spec.name}/{batch_id}.json", json.dumps(row))


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """One row for each load of each table."""
    if not path_exists(spark, _audit_path(root)):
        return empty_frame(spark, LOAD_AUDIT.schema)
    stored = T.StructType([T.StructField(f.name, T.LongType() if f.name == INGEST_TS else f.dataType) for f in LOAD_AUDIT.schema.fields])
    rows = spark.read.schema(stored).option("recursiveFileLookup", "true").json(_audit_path(root))
    return rows.withColumn(INGEST_TS, F.timestamp_micros(INGEST_TS))


def read_table(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """The stored table (all versions of a type 2 one), or no rows before the first load."""
    table = store_of(spark, spec, root)
    if not table.exists():
        return empty_frame(spark, spec.schema)
    return table.history() if isinstance(table, Scd2Table) else table.read().drop(KEY_BLOCK)


def log_findings(findings: DataFrame, path: str) -> None:
    """Keep the findings of a check run next to those of earlier runs; repeating a run replaces its own."""
    append_batch(findings, path, [INGEST_TS, "table_name"])
