"""Declarations: what a table, an ingestion pipeline and a model are.  Nothing here touches data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

# Audit column every stored row carries: the batch timestamp, passed in explicitly, never now().
INGEST_TS = "ingest_ts"
# What a dimension or fact calls the ingest timestamp of the row it was derived from.
SOURCE_INGEST_TS = "source_ingest_ts"

# Storage column of tables with key blocks; not part of the table as readers see it.
KEY_BLOCK = "key_block"

SCD_START = "scd_start_ts"
SCD_END = "scd_end_ts"
SCD_CURRENT = "scd_is_current"
SCD_COLUMNS = (SCD_START, SCD_END, SCD_CURRENT)


# What the audit row of a load counts; NULL where the kind of load has no such rows.
AUDIT_COUNTS = ("rows_read", "rows_rejected", "rows_insert", "rows_update", "rows_ignore", "rows_delete", "rows_change",
                "rows_unchanged", "rows_close", "rows_revised")


class SaveMode(Enum):
    APPEND = "append"
    MERGE = "merge"
    MERGE_SCD2 = "merge_scd2"


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    ref_table: str
    ref_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    """Declared shape and write behaviour of one table."""

    name: str
    layer: str
    schema: T.StructType
    save_mode: SaveMode
    primary_key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    change_columns: tuple[str, ...] = ()
    # SCD2 only: attributes refreshed in place, without opening a version.
    overwrite_columns: tuple[str, ...] = ()
    # Merge only: a source row older than the stored one is ignored.
    version_column: str | None = None
    prune_key_range: bool = False
    # Merge only: (column that is fixed per key, width of a block in its units, seconds for timestamps).  The
    # table is stored in such blocks and a merge rewrites only those of its batch, for growing keys the newest.
    key_blocks: tuple[str, int] | None = None
    # Merge only: the partition columns are computed from the key, so a key never moves between partitions.
    partition_follows_key: bool = False
    evolve: bool = True
    # Tables stored by batch: batches that stay readable, and repeatable, after a run (0: all of them).
    keep_versions: int = 3
    foreign_keys: tuple[ForeignKey, ...] = field(default=())
    target_file_bytes: int = 100_000_000
    compression: str = "snappy"
    description: str = ""

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.layer}/{self.name}"


@dataclass(frozen=True)
class Pipeline:
    """Ingestion contract: land ``source`` in ``bronze``, clean it, merge it into ``silver``."""

    name: str
    bronze: TableSpec
    silver: TableSpec
    source: Callable[[SparkSession], DataFrame]
    transform: Callable[[DataFrame], DataFrame] = lambda df: df
    deletes: Callable[[SparkSession], DataFrame] | None = None
    # Errors to look for in every source row (see conform.row_error), besides those that the source lists itself.
    checks: Callable[[], list[Column]] | None = None


@dataclass(frozen=True)
class Model:
    """Modelling contract: a gold table and the function that generates the rows to merge into it."""

    table: TableSpec
    generate: Callable[..., DataFrame]


def schema_of(columns: dict[str, str | T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    """Schema from ``{name: type}``; the ``required`` columns are declared not nullable."""
    schema = T.StructType()
    for name, data_type in columns.items():
        schema = schema.add(name, data_type, name not in required)
    return schema


def with_ingest_ts(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(INGEST_TS, T.TimestampType(), True)])
