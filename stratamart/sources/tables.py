"""How tables lie on shared storage: plain Parquet directories that any Spark reader understands.

Spark cannot overwrite what it is reading, so every merge writes somewhere new:

* ``SnapshotTable``   - ``v=<n>`` directories, the newest complete one (``_SUCCESS``) is the table;
* ``Scd2Table``       - ``v=<n>/scd_is_current=true|false``: all open versions, and those closed by batch n; and
  ``revised/v=<n>``, the keys whose older closed versions batch n replaced from some time on;
* ``PartitionedTable`` - one directory per partition value, replaced partition by partition.

One writer per table.  Writing version n again gives the same version n, so lost runs are simply repeated.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.scalars import utc_datetime, utc_literal
from stratamart.operators.audit import LoadCounts
from stratamart.operators.conform import drop_null_keys, evolve, merged_schema
from stratamart.operators.merge import compared, prepared, upsert
from stratamart.operators.pairing import prefer_broadcast
from stratamart.operators.scd2 import (
    REVISED_FROM, apply_scd2, empty_history, first_changes, reached, splice_at_once, splice_events, splice_scd2,
)
from stratamart.operators.skew import hot_keys, may_be_skewed
from stratamart.session import freed_shuffles
from stratamart.sources.files import (
    delete_path, matching_paths, move_files, move_path, path_exists, read_note, unescaped, write_note,
)
from stratamart.spec import KEY_BLOCK, SCD_COLUMNS, SCD_CURRENT, SCD_END

TARGET_FILE_BYTES = 100_000_000
# So few partitions are written where their rows were read: each task leaves at most as many files.
FEW_PARTITIONS = 4
# A batch of new keys with at least this share of the rows stored in its partitions is added to their files.
ADDED_SHARE = 0.1
# Dictionary pages grow up to this size: 64 digits of a key that repeats within a file are then stored once.
DICTIONARY_BYTES = 8_000_000

_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path for intermediate tables inside the shared folder the session names.

    Only a local session without ``spark.checkpoint.dir`` falls back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.conf.get("spark.app.id", "local")
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="run-")
        shared = _local_scratch[app]
    return f"{shared.rstrip('/')}/stratamart-{uuid.uuid4().hex}"


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or no rows before the first load, in the declared schema either way."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else empty_frame(spark, schema)


def write_files(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    compression: str = "snappy",
    target_file_bytes: int = TARGET_FILE_BYTES,
    rebalance: bool = False,
    dynamic: bool = False,
) -> None:
    """Write Parquet files of about the target size.

    ``rebalance`` adds an adaptive exchange that merges small and splits large partitions; without it the
    plan's last exchange (already sized by AQE) or the input splits decide.  ``dynamic`` replaces only the
    partitions present in the frame.
    """
    conf = df.sparkSession.conf
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = conf.get(name)
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df.hint("rebalance")
    writer = df.write.mode(mode).option("compression", compression).option("parquet.dictionary.page.size", DICTIONARY_BYTES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    conf.set(name, str(target_file_bytes))
    try:
        with freed_shuffles(df.sparkSession):
            writer.parquet(path)
    finally:
        conf.set(name, before)


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """The frame written to shared storage and read back: lineage is cut and survives lost executors.

    Who gives the ``path`` may delete it once nothing reads the copy any more.
    """
    path = path or scratch_dir(df.sparkSession)
    write_files(df, path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_batch(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    *,
    rebalance: bool = False,
    target_file_bytes: int = TARGET_FILE_BYTES,
    compression: str = "snappy",
) -> None:
    """Add a batch as its own partitions; repeating the batch replaces them instead of doubling the rows.

    A batch that is one partition is written where it was read, without a shuffle; ``rebalance`` one that
    spreads over many, or every task leaves a small file in each of them.
    """
    write_files(df, path, partition_by=partition_by, rebalance=rebalance, dynamic=True,
                target_file_bytes=target_file_bytes, compression=compression)


def _staged_batch(batch: DataFrame, key: Sequence[str], options: dict) -> DataFrame:
    """The deduplicated batch, written once: a merge looks at it several times, and the size of its files
    decides truthfully whether it may be broadcast."""
    version = options.get("version")
    order = [*([version] if version else []), *[c for c in options.pop("order_by", ()) if c != version]]
    return staged(prepared(batch, key, order, options.pop("on_duplicate", "latest"), options.get("counts")))


class OutOfOrder(ValueError):
    """A batch comes again although later ones are stored: its correction would not reach them."""


# A ledger entry: the ingest batch of a source that a merge has taken in.
CONSUMED = "source string, consumed_ts timestamp"


def _numbers(paths: Sequence[str], name: str) -> list[int]:
    """The numbers of ``<name>=<number>`` folders, ascending."""
    return sorted(int(p.rsplit(f"/{name}=", 1)[1].split("/")[0]) for p in paths)


class SnapshotTable:
    """A table rewritten as a whole by every merge."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return _numbers(matching_paths(self.spark, f"{self.path}/v=*/_SUCCESS"), "v")

    def before(self, version: int) -> int | None:
        """The version that batch ``version`` starts from.  Only the newest batch can be repeated."""
        stored = self.versions()
        if stored and stored[-1] > version:
            raise OutOfOrder(f"batch {version} of {self.path} comes after batch {stored[-1]}")
        older = [v for v in stored if v < version]
        return older[-1] if older else None

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions; with two, the newest batch can still be repeated."""
        for version in self.versions()[:-max(1, keep)]:
            self._delete(f"{self.path}/v={version}")

    def _delete(self, path: str) -> None:
        delete_path(self.spark, path)

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """Newest complete snapshot, or the newest one not after ``version``."""
        usable = [v for v in self.versions() if version is None or v <= version]
        if not usable:
            if self.schema is None:
                raise FileNotFoundError(f"no complete snapshot under {self.path}")
            return empty_frame(self.spark, self.schema)
        return self.spark.read.parquet(f"{self.path}/v={usable[-1]}")

    def write(self, df: DataFrame, version: int, **layout) -> None:
        write_files(df, f"{self.path}/v={version}", **layout)

    def consumed(self, before: int | None = None) -> DataFrame:
        """The (source, consumed_ts) pairs of the complete batches, or of those before one that is about to be written."""
        stored = self.versions()
        upto = stored[-1] if stored else -1
        if before is not None:
            upto = min(upto, before - 1)
        entries = _numbers(matching_paths(self.spark, f"{self.path}/consumed/v=*/_SUCCESS"), "v")
        paths = [f"{self.path}/consumed/v={v}" for v in entries if v <= upto]
        schema = T.StructType.fromDDL(CONSUMED)
        return self.spark.read.schema(schema).parquet(*paths).distinct() if paths else empty_frame(self.spark, schema)

    def _enter(self, consumed: DataFrame | None, batch_id: int) -> None:
        """Note what a batch takes in.  It counts once the version is complete, so notes of broken-off runs go first."""
        stored = self.versions()
        for v in _numbers(matching_paths(self.spark, f"{self.path}/consumed/v=*"), "v"):
            if v == batch_id or not stored or v > stored[-1]:
                self._delete(f"{self.path}/consumed/v={v}")
        if consumed is not None:
            write_files(consumed.select("source", "consumed_ts").coalesce(1), f"{self.path}/consumed/v={batch_id}")

    def merge(self, batch: DataFrame, key: Sequence[str], batch_id: int, *, deletes: DataFrame | None = None,
              layout: dict | None = None, consumed: DataFrame | None = None, **options) -> None:
        """Upsert a batch (and drop deleted keys) as version ``batch_id``, always from the version before it.

        ``consumed`` lists what the batch took in (see `CONSUMED`).
        """
        base = self.before(batch_id)
        self._enter(consumed, batch_id)
        target = self.read(base) if base is not None else empty_frame(self.spark, self.schema or batch.schema)
        merged = upsert(target, _staged_batch(batch, key, options), key, unique=True, deletes=deletes, **options)
        self.write(merged, batch_id, **(layout or {}))


class Scd2Table(SnapshotTable):
    """A type 2 dimension: each batch rewrites the open versions and adds the versions it closed."""

    def _part(self, version: int, current: bool) -> str:
        return f"{self.path}/v={version}/{SCD_CURRENT}={str(current).lower()}"

    def current(self, version: int | None = None) -> DataFrame:
        """Open versions after the given batch (default: after the last one)."""
        usable = [v for v in self.versions() if version is None or v <= version]
        path = self._part(usable[-1], True) if usable else None
        if path is None or not path_exists(self.spark, path):
            return self._empty(usable)
        return self._ordered(self.spark.read.parquet(path).withColumn(SCD_CURRENT, F.lit(True)))

    def history(self, version: int | None = None) -> DataFrame:
        """All versions known after the given batch."""
        usable = [v for v in self.versions() if version is None or v <= version]
        upto = [v for v in self._compacted() if version is None or v <= version]
        done = upto[-1] if upto else -1
        stored = matching_paths(self.spark, f"{self.path}/v=*/{SCD_CURRENT}=false")
        closed = [p for p in stored if (v := int(p.rsplit("/v=", 1)[1].split("/")[0])) in usable and v > done]
        closed += [f"{self.path}/closed/upto={done}"] if upto else []
        out = self.current(version)
        if closed:
            # The open versions have the latest schema; older files lack its new columns and read them as NULL.
            schema = T.StructType([f for f in out.schema.fields if f.name != SCD_CURRENT])
            revisions = [v for v in self._revisions() if v in usable and v > done]
            # What the newest of these batches closed itself, no batch has replaced.
            old = [p for p in closed if "/upto=" in p or int(p.rsplit("/v=", 1)[1].split("/")[0]) < revisions[-1]] if revisions else []
            new = [p for p in closed if p not in old]
            for paths in filter(None, (old, new)):
                rows = self.spark.read.schema(schema).parquet(*paths)
                rows = self._unrevised(rows, revisions) if paths is old else rows
                out = out.unionByName(rows.withColumn(SCD_CURRENT, F.lit(False)))
        return out

    def _revisions(self) -> list[int]:
        return _numbers(matching_paths(self.spark, f"{self.path}/revised/v=*/_SUCCESS"), "v")

    def _unrevised(self, closed: DataFrame, revisions: list[int]) -> DataFrame:
        """Closed versions without those that a later batch replaced: of its keys, and ended at its times or later."""
        def batch_of_file(*names: str) -> Column:
            return F.regexp_extract("_metadata.file_path", f".*/(?:{'|'.join(names)})=([0-9]+)/", 1).cast("long")
        later = self.spark.read.parquet(*[f"{self.path}/revised/v={v}" for v in revisions])
        key = [c for c in later.columns if c != REVISED_FROM]
        later = later.select(*[F.col(c).alias(f"__{c}") for c in key], REVISED_FROM, batch_of_file("v").alias("__later"))
        replaced = (F.col("__later") > F.col("__batch")) & (F.col(SCD_END) >= F.col(REVISED_FROM))
        for c in key:
            replaced = replaced & (F.col(c) == F.col(f"__{c}"))
        return closed.withColumn("__batch", batch_of_file("v", "upto")).join(later, replaced, "left_anti").drop("__batch")

    def _compacted(self) -> list[int]:
        return _numbers(matching_paths(self.spark, f"{self.path}/closed/upto=*/_SUCCESS"), "upto")

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` batches; the versions that the others closed go to one folder first.

        A run that breaks off leaves both the folder and the batches, and readers take the folder.
        """
        old = self.versions()[:-max(1, keep)]
        if not old:
            return
        before = self._compacted()
        if not before or before[-1] < old[-1]:
            history = self.history(old[-1])
            closed = history.filter(~F.col(SCD_CURRENT)).drop(SCD_CURRENT)
            write_files(closed, f"{self.path}/closed/upto={old[-1]}", rebalance=True)
        for done in before[:-1] if before and before[-1] >= old[-1] else before:
            self._delete(f"{self.path}/closed/upto={done}")
        for version in old:
            self._delete(f"{self.path}/v={version}")
            self._delete(f"{self.path}/revised/v={version}")

    def _empty(self, usable: list[int]) -> DataFrame:
        if self.schema is not None:
            return empty_history(empty_frame(self.spark, self.schema))
        if not usable:
            raise FileNotFoundError(f"no complete version under {self.path}")
        return empty_frame(self.spark, self.spark.read.parquet(f"{self.path}/v={usable[-1]}").schema)

    @staticmethod
    def _ordered(df: DataFrame) -> DataFrame:
        return df.select(*[c for c in df.columns if c not in SCD_COLUMNS], *SCD_COLUMNS)

    def apply(self, batch: DataFrame, key: Sequence[str], change: Sequence[str], batch_id: int,
              batch_ts: datetime, *, layout: dict | None = None, **options) -> None:
        """Fold a batch in as version ``batch_id``, always from the version before it."""
        base = self.before(batch_id)
        current = self.current(base) if base is not None else empty_history(
            empty_frame(self.spark, self.schema) if self.schema is not None else batch
        )
        staged_batch = _staged_batch(batch, key, options)
        self._delete(f"{self.path}/revised/v={batch_id}")  # of a late batch with this number that broke off
        rows = apply_scd2(current, staged_batch, key, change, batch_ts, unique=True, **options)
        write_files(rows, f"{self.path}/v={batch_id}", partition_by=[SCD_CURRENT], **(layout or {}))


    def splice(self, rows: DataFrame, key: Sequence[str], change: Sequence[str], batch_id: int, *, ts: str,
               observed: DataFrame | None = None, order_by: Sequence[str] = (), layout: dict | None = None,
               counts: LoadCounts | None = None) -> None:
        """Take in rows of any times, late ones included, as version ``batch_id``; the history is that of a rebuild.

        ``ts`` names the column with each row's time; it does not become an attribute.  ``observed``, with the same columns,
        gives the rows taken in so far: only its rows of these keys, from their first late row on, are read.  Histories of
        other keys, and versions that ended before, are neither read as closed versions nor written again: the batch stores
        what takes their place, and a list of its keys that readers compare older closed versions with.
        """
        key, base = list(key), self.before(batch_id)
        earliest = Observation(f"earliest-{uuid.uuid4().hex}")
        late = prepared(rows, [*key, ts], order_by, counts=counts)
        late = staged(late.observe(earliest, F.unix_micros(F.min(ts)).alias("at")))
        since = utc_datetime(earliest.get.get("at"))
        if base is not None:
            known, current = self.history(base), self.current(base)
        else:
            first = late.drop(ts) if self.schema is None else empty_frame(self.spark, self.schema)
            known = current = empty_history(first)
        self._delete(f"{self.path}/revised/v={batch_id}")  # of a run that broke off
        out = current
        if since is not None:
            out = None if prefer_broadcast(known, late) else self._spliced_at_once(
                known, late, key, change, batch_id, ts, since, observed, order_by, counts)
            if out is None:
                out = self._spliced_by_joins(known, current, late, key, change, batch_id, ts, since, observed, order_by, counts)
        write_files(self._ordered(out), f"{self.path}/v={batch_id}", partition_by=[SCD_CURRENT], **(layout or {}))

    def _spliced_at_once(self, known: DataFrame, late: DataFrame, key: list[str], change: Sequence[str], batch_id: int, ts: str,
                         since: datetime, observed: DataFrame | None, order_by: Sequence[str], counts: LoadCounts | None) -> DataFrame | None:
        """For batches that are not small against the table: one shuffle by key; None if there are hot keys."""
        events = splice_events(known, late, key, ts, since, observed)
        if may_be_skewed(events) and not hot_keys(events, key).isEmpty():
            return None
        closed = known.filter(F.col(SCD_END).isNotNull()).select(*key, SCD_END)
        closed = reached(closed, first_changes(late, key, ts), key, since).select(*key, REVISED_FROM).distinct()
        self._enter_revised(closed, batch_id, counts)
        return splice_at_once(events, key, change, ts, order_by=order_by)

    def _spliced_by_joins(self, known: DataFrame, current: DataFrame, late: DataFrame, key: list[str], change: Sequence[str],
                          batch_id: int, ts: str, since: datetime, observed: DataFrame | None, order_by: Sequence[str],
                          counts: LoadCounts | None) -> DataFrame:
        """For small batches, which are broadcast, and for hot keys: the versions that the batch reaches are looked up first."""
        firsts = first_changes(late, key, ts)
        cut = staged(reached(known, firsts, key, since))
        if observed is not None:
            observed = observed.filter(F.col(ts) >= utc_literal(since)).join(firsts, key)
            observed = observed.filter(F.col(ts) >= F.col(REVISED_FROM)).drop(REVISED_FROM)
        versions = splice_scd2(cut.drop(REVISED_FROM), late, key, change, ts, observed=observed, order_by=order_by)
        self._enter_revised(cut.filter(F.col(SCD_END).isNotNull()).select(*key, REVISED_FROM).distinct(), batch_id, counts)
        kept, versions = evolve(current.join(firsts, key, "left_anti"), versions)
        return kept.unionByName(versions)

    def _enter_revised(self, closed: DataFrame, batch_id: int, counts: LoadCounts | None) -> None:
        """Note the keys whose closed versions a batch replaces, if there are any.  They count once the batch is complete."""
        path, seen = f"{self.path}/revised/v={batch_id}", Observation(f"revised-{uuid.uuid4().hex}")
        write_files(closed.observe(seen, F.count(F.lit(1)).alias("n")), path)
        n = seen.get.get("n")
        if not n:
            self._delete(path)
        elif counts is not None:
            counts.add(rows_revised=n)


class MovedKeys(ValueError):
    """A batch holds keys that are stored under another partition value."""


class PartitionedTable:
    """A table merged partition by partition: the rest of it is neither read nor rewritten.

    The partition value of a key must never change, otherwise its old row would survive in the old partition.  A merge
    fails on such keys (`MovedKeys`), unless ``follows_key`` declares that the partition columns are computed from
    the key, which saves reading the stored keys.

    A merge first stores the new partitions next to the table (``<path>-pending``) and then moves them in place of the old
    ones.  If it breaks off in between, the next merge (or `recover`) moves the rest before it reads the table.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str], schema: T.StructType,
                 *, evolving: bool = False, follows_key: bool = False, key_blocks: tuple[str, int] | None = None):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)
        self.schema, self.follows_key, self.key_blocks = schema, follows_key, key_blocks
        # Columns added since are remembered as empty snapshots: reading all footers would not scale.
        self.evolved = SnapshotTable(spark, f"{self.path}-schema") if evolving else None

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def known_schema(self) -> T.StructType:
        """The declared columns; with ``evolving`` also those added since."""
        return self.evolved.read().schema if self.evolved is not None and self.evolved.exists() else self.schema

    def read(self) -> DataFrame:
        schema = self.known_schema()
        if not self.exists():
            return empty_frame(self.spark, schema)
        # An explicit schema also keeps the declared type of partition columns, whose directory names are text.
        return self.spark.read.schema(schema).parquet(self.path).select(*schema.names)

    def append(self, rows: DataFrame, *, counts: LoadCounts | None = None, **layout) -> None:
        """Add a batch as its own partitions, see `append_batch`."""
        self._remember(rows.schema)
        if counts is not None:
            rows = counts.watch(rows, rows_read=F.count(F.lit(1)), rows_insert=F.count(F.lit(1)))
        append_batch(rows, self.path, self.partition_by, **layout)

    def touched(self, batch: DataFrame, deletes: DataFrame | None = None, key: Sequence[str] = ()) -> DataFrame:
        """Stored rows of the partitions present in the batch, and of those that hold deleted keys."""
        stored = self.read()
        parts = self._parts(stored, batch, deletes, key)
        return self._within(stored, parts, self._values(parts))

    def _within(self, stored: DataFrame, parts: DataFrame, values: list[Row]) -> DataFrame:
        rows = stored.filter(self._listed(values))
        return rows if len(self.partition_by) == 1 else self._semi(rows, parts, "left_semi")

    def _parts(self, stored: DataFrame, batch: DataFrame, deletes: DataFrame | None, key: Sequence[str]) -> DataFrame:
        parts = batch.select(*self.partition_by)
        if deletes is not None:
            hit = stored.select(*{*key, *self.partition_by}).join(deletes.select(*key), list(key), "left_semi")
            parts = parts.unionByName(hit.select(*self.partition_by))
        return parts.distinct()

    def _values(self, parts: DataFrame) -> list[Row]:
        """The partition values on the driver: one row for each directory that the batch writes, all of which Spark's driver
        lists for any partitioned table.  Timestamps come as microseconds."""
        timed = {c for c in self.partition_by if isinstance(parts.schema[c].dataType, T.TimestampType)}
        return parts.select(*[F.unix_micros(c).alias(c) if c in timed else F.col(c) for c in self.partition_by]).collect()

    def _listed(self, rows: list[Row]) -> Column:
        """Filter on literal partition values, NULL included, which prunes while the scan is planned.

        With several columns the filter lets through combinations of their values.
        """
        kinds = {f.name: f.dataType for f in self.schema.fields}
        hit = F.lit(True)
        for c in self.partition_by:
            timed = isinstance(kinds[c], T.TimestampType)
            values = {r[c] for r in rows}
            present = [F.timestamp_micros(F.lit(v)) if timed else F.lit(v) for v in values if v is not None]
            one = F.col(c).isin(*present) if present else F.lit(False)
            hit = hit & (one | F.col(c).isNull() if None in values else one)
        return hit

    def _semi(self, rows: DataFrame, parts: DataFrame, how: str) -> DataFrame:
        """``rows`` in (left_semi) or not in (left_anti) these partitions; NULL is a value like any other."""
        other = parts.select(*[F.col(c).alias(f"__{c}") for c in self.partition_by])
        same = F.lit(True)
        for c in self.partition_by:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        return rows.join(other, same, how)

    def merge(self, batch: DataFrame, key: Sequence[str], batch_id: int | None = None, *, deletes: DataFrame | None = None,
              layout: dict | None = None, writer: str = "batch", consumed: DataFrame | None = None, stored: bool = False,
              **options) -> None:
        """Upsert a batch into the partitions it touches.

        ``batch_id`` is entered in the table's ledger, together with the rows of ``consumed`` (see `CONSUMED`), by the very
        step that makes the batch visible.  A batch older than the writer's newest one is refused, as its rows would win over
        later ones, unless a version column decides that.  Without ``batch_id`` the last writer wins.  ``stored`` says that the
        batch is read from stored tables, cheap to read and the same each time, so that it needs no copy of its own.
        """
        layout = layout or {}
        self.recover(layout)
        batch = self._blocked(batch)
        if batch_id is not None and options.get("version") is None:
            newest = self.applied(writer)
            if newest is not None and newest > batch_id:
                raise OutOfOrder(f"batch {batch_id} of {self.path} comes after batch {newest}")
        for f in batch.schema.fields:
            if f.name in self.partition_by and isinstance(f.dataType, T.StringType):
                # A directory name cannot be empty: Parquet tables store an empty partition value as NULL.
                batch = batch.withColumn(f.name, F.nullif(F.col(f.name), F.lit("")))
        fixed = self.follows_key or set(self.partition_by) <= set(key) or not self.exists()
        plain, adds = None, False
        if fixed and deletes is None:
            batch = batch if stored else staged(batch)
            plain = self._plain(batch, key, options)
        if plain is not None:
            merged, n_parts, adds = plain
        else:
            batch = _staged_batch(batch, key, options)
            if not fixed:
                moved = self.moved_keys(batch, key).take(3)
                if moved:
                    raise MovedKeys(f"keys stored under another partition value, for example {[tuple(r) for r in moved]}")
            present = self.read()
            parts = self._parts(present, batch, deletes, key)
            values = self._values(parts)
            merged = upsert(self._within(present, parts, values), batch, key, unique=True, deletes=deletes, **options)
            n_parts = len(values)
        # Remembered before the data is written: until then the new columns simply read NULL.
        self._remember(merged.schema)
        laid_out = {"partition_by": self.partition_by, "rebalance": plain is None or n_parts > FEW_PARTITIONS, **layout}
        if not self.exists() and batch_id is None:
            write_files(merged, self.path, dynamic=True, **laid_out)
            return
        delete_path(self.spark, self._pending)  # of a merge that broke off before its copy was complete
        write_files(merged, f"{self._pending}/rows", **laid_out)
        emptied = []
        if deletes is not None:
            kept = self.spark.read.schema(merged.schema).parquet(f"{self._pending}/rows")
            emptied = [r["directory"] for r in self._emptied(batch, deletes, key, kept).collect()]
        if consumed is not None:
            write_files(consumed.select("source", "consumed_ts").coalesce(1), f"{self._pending}/consumed")
        # Written last: it says that the copy is complete.
        write_note(self.spark, f"{self._pending}/commit", json.dumps(
            {"emptied": emptied, "writer": writer, "batch_id": batch_id, "laid_out": True, "adds": adds}))
        self.recover(layout)

    def _plain(self, batch: DataFrame, key: Sequence[str], options: dict) -> tuple[DataFrame, int, bool] | None:
        """Rows to write, the number of their partitions, and whether they are added to the stored ones or take their place;
        None unless the batch replaces all stored rows of its partitions or none, each key once.

        Then whole rows need not be joined: the keys and versions alone, which are far narrower, tell whether that is so.
        New keys are added as files of their own, without a copy of the stored rows; those of small batches are written
        together with the stored rows, so that the files of a partition do not become many.
        """
        present, keyed = self.read(), drop_null_keys(batch, key)
        # Of all rows, without key too: then no key has to be computed to find them, and a partition more is compared at most.
        parts = self._parts(present, batch, None, key)
        values = self._values(parts)
        touched = self._within(present, parts, values)
        if self.exists() and prefer_broadcast(touched, batch):
            return None
        with freed_shuffles(self.spark):
            found = compared(touched, batch, key, options.get("version"))
        if found["repeated"] or found["ignore"] or found["keep"] and found["update"]:
            return None
        if options.get("counts") is not None:
            options["counts"].add(**{f"rows_{kind}": found[kind] for kind in ("read", "rejected", "insert", "update", "ignore")})
        if options.get("allow_new_columns", True):
            touched, keyed = evolve(touched, keyed)
        else:
            keyed = keyed.select(*touched.columns)
        adds = found["keep"] > 0 and found["insert"] >= ADDED_SHARE * found["keep"]
        return (touched.unionByName(keyed) if found["keep"] and not adds else keyed), len(values), adds

    def _blocked(self, rows: DataFrame) -> DataFrame:
        """Rows with the storage column of a table that has key blocks."""
        if self.key_blocks is None or KEY_BLOCK in rows.columns:
            return rows
        column, size = self.key_blocks
        timed = isinstance(rows.schema[column].dataType, T.TimestampType)
        number = F.unix_seconds(F.col(column)) if timed else F.col(column)
        return rows.withColumn(KEY_BLOCK, F.floor(number / size))

    @property
    def _ledger(self) -> str:
        return f"{self.path}-ledger"

    def applied(self, writer: str = "batch") -> int | None:
        """The newest batch of a writer that is in the table."""
        done = _numbers(matching_paths(self.spark, f"{self._ledger}/writer={writer}/batch_id=*/_applied"), "batch_id")
        return done[-1] if done else None

    def consumed(self) -> DataFrame:
        """The (source, consumed_ts) pairs of all batches in the table."""
        schema = T.StructType.fromDDL(f"{CONSUMED}, writer string, batch_id long")
        return read_or_empty(self.spark, self._ledger, schema).select("source", "consumed_ts").distinct()

    @property
    def _pending(self) -> str:
        return f"{self.path}-pending"

    def recover(self, layout: dict | None = None) -> bool:
        """Finish a merge that broke off after its copy was complete; repeating this is harmless."""
        commit = read_note(self.spark, f"{self._pending}/commit")
        if commit is None:
            return False
        commit = json.loads(commit)
        if commit.get("laid_out"):
            # As any write of Spark leaves it: a folder with its mark, also where no partition has rows.
            write_files(empty_frame(self.spark, self.known_schema()), self.path, partition_by=self.partition_by, dynamic=True)
            # What was moved before is not found again.
            move = move_files if commit.get("adds") else move_path
            for part in matching_paths(self.spark, "/".join([f"{self._pending}/rows", *[f"{c}=*" for c in self.partition_by]])):
                move(self.spark, part, f"{self.path}/{part.rsplit('-pending/rows/', 1)[1]}")
        else:
            rows = self.spark.read.parquet(f"{self._pending}/rows")
            write_files(rows, self.path, partition_by=self.partition_by, rebalance=True, dynamic=True, **(layout or {}))
        for directory in commit["emptied"]:
            delete_path(self.spark, unescaped(self.spark, directory))
        if commit["batch_id"] is not None:
            entry = f"{self._ledger}/writer={commit['writer']}/batch_id={commit['batch_id']}"
            if path_exists(self.spark, f"{self._pending}/consumed"):
                move_path(self.spark, f"{self._pending}/consumed", entry)
            write_note(self.spark, f"{entry}/_applied", "")
        delete_path(self.spark, self._pending)
        return True

    def _remember(self, schema: T.StructType) -> None:
        if self.evolved is None:
            return
        version = len(self.evolved.versions())
        known = self.known_schema()
        merged = merged_schema(known, schema)
        if {(f.name, f.dataType) for f in merged.fields} != {(f.name, f.dataType) for f in known.fields}:
            self.evolved.write(empty_frame(self.spark, merged), version)

    def _emptied(self, batch: DataFrame, deletes: DataFrame, key: Sequence[str], merged: DataFrame) -> DataFrame:
        """Directories of partitions that lose their last row: overwriting by partition leaves those in place."""
        stored = self.read()
        parts = self._parts(stored, batch, deletes, key)
        files = stored.filter(self._listed(self._values(parts))).select(*self.partition_by, F.col("_metadata.file_path").alias("file"))
        directories = files.groupBy(*self.partition_by).agg(F.regexp_replace(F.max("file"), "/[^/]*$", "").alias("directory"))
        directories = self._semi(directories, parts, "left_semi")
        return self._semi(directories, merged.select(*self.partition_by).distinct(), "left_anti").select("directory")

    def moved_keys(self, batch: DataFrame, key: Sequence[str]) -> DataFrame:
        """Batch keys that are stored under another partition value: they would be duplicated by a merge."""
        stored = self.read().select(*key, *[F.col(c).alias(f"stored_{c}") for c in self.partition_by])
        moved = F.lit(False)
        for c in self.partition_by:
            moved = moved | ~F.col(c).eqNullSafe(F.col(f"stored_{c}"))
        return batch.select(*key, *[c for c in self.partition_by if c not in key]).distinct().join(
            stored, list(key)
        ).filter(moved)
