"""Runs, their ledgers, audit rows and quarantine, and pipelines as streams that break off."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from conftest import SMALL, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratamart.operators.conform import ROW_ERRORS, error_list, missing_keys
from stratamart.operators.latest import fresh_batches, only_batches
from stratamart.plans import runs
from stratamart.plans.ingestion import (
    CLEAN_INFO_A, CLEAN_STATUS_B, RAW_STATUS_B, STATUS_B_SOURCE, info_a_pipeline, status_b_pipeline,
)
from stratamart.plans.facts import FACT_BIKE_STATUS
from stratamart.plans.loads import load_status_fact
from stratamart.plans.runs import read_audit, read_quarantine, read_table, run_pipeline, save, store_of
from stratamart.registry import facts
from stratamart.sources import tables
from stratamart.sources.tables import CONSUMED, PartitionedTable, SnapshotTable
from stratamart.spec import INGEST_TS, Pipeline, SaveMode, TableSpec, schema_of, with_ingest_ts
from stratamart.streaming import pipelines
from stratamart.streaming.micro_batch import landed_stream, start, upsert_into
from stratamart.streaming.pipelines import BatchLedger, pipeline_into

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
KV = schema_of({"k": "integer", "v": "string"})
RAW = TableSpec("kv", "bronze", with_ingest_ts(KV), SaveMode.APPEND, ("k",), partition_by=(INGEST_TS,))
CLEAN = TableSpec("kv", "silver", with_ingest_ts(KV), SaveMode.MERGE, ("k",), version_column=INGEST_TS, key_blocks=("k", 10))


def audits(spark, root, layer, *columns):
    return rows(read_audit(spark, root).where(F.col("layer") == layer).select("batch_id", *columns))


def test_audit_rows_of_runs(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], KV)
    run_pipeline(spark, Pipeline("kv", RAW, CLEAN, lambda _: first), root, 0, T1)
    second = spark.createDataFrame([(2, "C"), (3, "e"), (None, "f"), (None, "g")], KV)
    gone = spark.createDataFrame([(1,), (3,), (9,)], "k int")
    pipeline = Pipeline("kv", RAW, CLEAN, lambda _: second, deletes=lambda _: gone)
    for _ in range(2):
        run_pipeline(spark, pipeline, root, 1, T2)
    assert audits(spark, root, "bronze", "rows_read", "rows_insert", INGEST_TS) == [(0, 4, 4, T1), (1, 4, 4, T2)]
    # The repeated run finds the rows of the first attempt: key 1 is gone, key 2 is there, key 3 is gone again.
    assert audits(spark, root, "silver", "rows_read", "rows_rejected", "rows_insert", "rows_update", "rows_delete") == [
        (0, 4, 1, 2, 0, None), (1, 4, 2, 1, 1, 1)]
    assert rows(read_table(spark, CLEAN, root).select("k", "v")) == [(2, "C")]


def test_audit_of_versions_and_ignored_rows(spark, tmp_path):
    root, spec = str(tmp_path), TableSpec("h", "gold", KV, SaveMode.MERGE_SCD2, ("k",), change_columns=("v",))
    save(spark, spec, root, spark.createDataFrame([(1, "a"), (2, "b")], KV), 0, T1)
    gone = spark.createDataFrame([(2,)], "k int")
    counted = save(spark, spec, root, spark.createDataFrame([(1, "A"), (3, "c"), (None, "x")], KV), 1, T2, gone)
    assert {k: v for k, v in counted.items() if v is not None} == {
        "rows_read": 3, "rows_rejected": 1, "rows_insert": 1, "rows_change": 1, "rows_unchanged": 0, "rows_close": 1}
    newer = spark.createDataFrame([(1, "new", T3)], CLEAN.schema)
    older = spark.createDataFrame([(1, "old", T1), (2, "b", T1)], CLEAN.schema)
    save(spark, CLEAN, root, newer, 0, T3)
    counted = save(spark, CLEAN, root, older, 1, T1)
    assert (counted["rows_ignore"], counted["rows_insert"], counted["rows_update"]) == (1, 1, 0)


def test_old_versions_go_as_runs_go_on(spark, tmp_path):
    root, spec = str(tmp_path), TableSpec("s", "gold", KV, SaveMode.MERGE, ("k",), keep_versions=2)
    for number in range(5):
        save(spark, spec, root, spark.createDataFrame([(number, "v")], KV), number, T1)
    assert store_of(spark, spec, root).versions() == [3, 4] and read_table(spark, spec, root).count() == 5


def test_a_late_batch_of_a_pipeline_is_spliced_in(spark, tmp_path):
    root = str(tmp_path)

    def info(capacity):
        geo = F.struct(F.lit(2.0).alias("lon"), F.lit(48.0).alias("lat"))
        return lambda s: s.range(1).select(F.lit("A").alias("stationcode"), F.lit("n").alias("name"), F.lit(capacity).alias("capacity"),
                                           geo.alias("coordonnees_geo"), F.lit("24h").alias("station_opening_hours"))
    for number, (at, capacity) in enumerate([(T1, 10), (T3, 10), (T2, 20)]):
        run_pipeline(spark, info_a_pipeline(info(capacity)), root, number, at)
    history = read_table(spark, CLEAN_INFO_A, root).select("capacity", "scd_start_ts", "scd_end_ts", INGEST_TS)
    assert rows(history) == [(10, T1, T2, T1), (10, T3, None, T3), (20, T2, T3, T2)]
    assert audits(spark, root, "silver", "rows_revised")[2] == (2, None)
    with pytest.raises(ValueError):
        late = replace(info_a_pipeline(info(30)), deletes=lambda s: s.createDataFrame([("A",)], "stationcode string"))
        run_pipeline(spark, late, root, 3, T2 + timedelta(days=1))


def test_of_a_stored_source_only_rows_with_errors_are_copied(spark, tmp_path, monkeypatch):
    copies, staged = [], runs.staged

    def counted(df, *path):
        out = staged(df, *path)
        copies.append(out.count())
        return out
    monkeypatch.setattr(runs, "staged", counted)
    second = 1_704_067_200
    source = spark.createDataFrame(
        [(s, second + (s or 0), 1, 0, 1, 0, 1, 1, 1, r) for s, r in [(1, second), (2, second), (None, second), (3, -3_000_000_000), (4, second)]],
        STATUS_B_SOURCE)
    found = []
    for stored in (False, True):
        root = str(tmp_path / str(stored))
        for batch in (source, source, source.where("station_id in (1, 2)")):
            run_pipeline(spark, status_b_pipeline(lambda _, b=batch: b), root, 0, T1, stored=stored)
            found.append([rows(read_table(spark, spec, root)) for spec in (RAW_STATUS_B, CLEAN_STATUS_B)]
                         + [rows(read_quarantine(spark, root)), rows(read_audit(spark, root))])
    assert found[:3] == found[3:] and [len(t) for t in found[0]] == [4, 3, 2, 2] and len(found[2][2]) == 0
    assert copies == [5, 5, 2, 2, 2, 0]


def test_late_status_rows_are_copied_only_if_they_have_errors(spark, monkeypatch):
    copies, staged = [], runs.staged

    def counted(df, *path):
        out = staged(df, *path)
        copies.append(out.count())
        return out
    monkeypatch.setattr(runs, "staged", counted)
    monkeypatch.setattr(facts, "staged", counted)
    n = facts.incremental_late_rows(spark, SMALL).count()
    assert 0 < sum(copies) < n / 10


# --- ledgers ----------------------------------------------------------------------------------------------

def test_older_batches_are_refused_where_the_last_writer_wins(spark, tmp_path):
    schema = schema_of({"k": "integer", "v": "string", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema, follows_key=True)
    for number in (0, 1):
        table.merge(spark.createDataFrame([(1, str(number), "x")], schema), ["k"], number)
    with pytest.raises(tables.OutOfOrder):
        table.merge(spark.createDataFrame([(1, "again", "x")], schema), ["k"], 0)
    table.merge(spark.createDataFrame([(1, "one", "x")], schema), ["k"], 1)
    table.merge(spark.createDataFrame([(2, "other", "x")], schema), ["k"], 0, writer="other")
    assert rows(table.read()) == [(1, "one", "x"), (2, "other", "x")]
    assert (table.applied(), table.applied("other"), table.applied("none")) == (1, 0, None)


def consumed(spark, *pairs):
    return spark.createDataFrame(list(pairs), CONSUMED)


def test_what_was_consumed_becomes_visible_with_the_rows(spark, tmp_path, monkeypatch):
    schema = schema_of({"k": "integer", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema, follows_key=True)
    table.merge(spark.createDataFrame([(1, "x")], schema), ["k"], 0, consumed=consumed(spark, ("s", T1)))
    written = tables.write_files

    def broken(df, path, **options):
        if path == table.path:
            raise RuntimeError("lost")
        written(df, path, **options)
    monkeypatch.setattr(tables, "write_files", broken)
    with pytest.raises(RuntimeError, match="lost"):
        table.merge(spark.createDataFrame([(2, "x")], schema), ["k"], 1, consumed=consumed(spark, ("s", T2)))
    assert rows(table.consumed()) == [("s", T1)] and table.applied() == 0
    monkeypatch.setattr(tables, "write_files", written)
    assert table.recover() and rows(table.consumed()) == [("s", T1), ("s", T2)] and table.applied() == 1
    assert rows(table.read()) == [(1, "x"), (2, "x")]


def test_snapshots_count_complete_batches_only(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"), KV)
    table.merge(spark.createDataFrame([(1, "a")], KV), ["k"], 0, consumed=consumed(spark, ("s", T1)))
    monkeypatch.setattr(SnapshotTable, "write", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.merge(spark.createDataFrame([(2, "b")], KV), ["k"], 1, consumed=consumed(spark, ("s", T2)))
    monkeypatch.undo()
    assert rows(table.consumed()) == [("s", T1)]
    table.merge(spark.createDataFrame([(3, "c")], KV), ["k"], 2, consumed=consumed(spark, ("s", T3)))
    # The batch that broke off was not taken in, although a later one was.
    assert rows(table.consumed()) == [("s", T1), ("s", T3)] and rows(table.consumed(before=2)) == [("s", T1)]


def test_fresh_batches_are_a_set_difference(spark):
    a = spark.createDataFrame([(1, T1), (2, T2), (3, T3), (4, None)], "k int, ingest_ts timestamp")
    b = a.filter("k = 2")
    fresh = fresh_batches({"a": a, "b": b, "none": a.limit(0)}, consumed(spark, ("a", T1), ("a", T3), ("b", T1)))
    assert rows(fresh) == [("a", T2), ("b", T2)]
    cut = only_batches({"a": a, "b": b, "none": a}, fresh)
    assert [rows(cut[n].select("k")) for n in ("a", "b", "none")] == [[(2,)], [(2,)], []]
    with pytest.raises(ValueError):
        fresh_batches({}, fresh)


# --- quarantine -------------------------------------------------------------------------------------------

def test_quarantine_splits_one_batch(spark, tmp_path):
    root, found = str(tmp_path), []
    checks = lambda: missing_keys(["k"])
    pipeline = Pipeline("kv", RAW, CLEAN, lambda _: found[0], checks=checks)
    found.append(spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], KV))
    run_pipeline(spark, pipeline, root, 0, T1)
    bad = read_quarantine(spark, root).select("pipeline", "batch_id", "column", "reason", "rejected", "record", INGEST_TS)
    assert rows(bad) == [("kv", 0, "k", "missing key", True, '{"v":"b"}', T1), ("kv", 0, "k", "missing key", True, '{"v":"c"}', T1)]
    assert audits(spark, root, "bronze", "rows_read", "rows_insert", "rows_rejected") == [(0, 3, 1, 2)]
    assert audits(spark, root, "silver", "rows_read", "rows_rejected") == [(0, 1, 0)]
    # A repeated batch replaces its own errors, also by none; errors that reject nothing leave the row in.
    found[0] = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    run_pipeline(spark, pipeline, root, 0, T1)
    assert read_quarantine(spark, root).count() == 0
    odd = F.struct(F.lit("v").alias("column"), F.col("v").alias("value"), F.lit("odd").alias("reason"), F.lit(False).alias("rejected"))
    found[0] = found[0].withColumn(ROW_ERRORS, error_list([F.when(F.col("k") == 2, odd)]))
    run_pipeline(spark, pipeline, root, 1, T2)
    assert rows(read_quarantine(spark, root).select("column", "value", "reason", "rejected")) == [("v", "b", "odd", False)]
    assert rows(read_table(spark, CLEAN, root).select("k")) == [(1,), (2,)] and ROW_ERRORS not in read_table(spark, RAW, root).columns


# --- streams ----------------------------------------------------------------------------------------------

def states(spark, path, batches):
    for data in batches:
        made = [(k, at, bikes, 0, 5, 0, 1, 1, 1, at) for k, at, bikes in data]
        spark.createDataFrame(made, STATUS_B_SOURCE).coalesce(1).write.mode("append").json(path)


BATCHES = [[(1, 86_400, 3), (2, 86_400, 4)], [(1, 86_400, 9), (1, 200_000, 5)], [(2, 200_000, 6), (1, 86_400, 1)]]


def drain(spark, tmp_path, times, then=()):
    pipeline = status_b_pipeline(lambda s: None)
    handler = pipeline_into(pipeline, str(tmp_path / "lake"), then=then, clock=lambda: next(times))
    stream = landed_stream(spark, str(tmp_path / "landing"), STATUS_B_SOURCE, max_files=1)
    start(stream, handler, str(tmp_path / "c"), every=None).awaitTermination()


def tables_of(spark, tmp_path):
    root = str(tmp_path / "lake")
    return (rows(read_table(spark, RAW_STATUS_B, root).select("station_id", "last_updated", "num_bikes_available", INGEST_TS)),
            rows(read_table(spark, CLEAN_STATUS_B, root).select("station_id", "last_updated", "num_bikes_available", INGEST_TS)),
            rows(read_table(spark, FACT_BIKE_STATUS, root).select("station_id", "timestamp", "available_bikes", "source_ingest_ts")))


@pytest.mark.parametrize("step", ["land", "clean", "fact", "after"])
def test_a_stream_that_breaks_off_goes_on_where_it_was(spark, tmp_path, monkeypatch, step):
    """Broken in the second of three micro-batches, before or within a table or between two of them."""
    states(spark, str(tmp_path / "landing"), BATCHES)
    times, tries = iter([T1, T2, T3, datetime(2030, 1, 1)]), []

    def fact(s, batch_id, at):
        if step == "fact" and batch_id == 1 and not tries:
            tries.append(1)
            raise RuntimeError("lost")
        load_status_fact(s, str(tmp_path / "lake"), batch_id, at, writer="station_status_b")
    real_save, real_finish = runs.save, BatchLedger.finish

    def broken_save(s, spec, root, data, batch_id, *args, **options):
        if spec.name == "station_status_b" and spec.layer == {"land": "bronze", "clean": "silver"}.get(step) and batch_id == 1 and not tries:
            tries.append(1)
            raise RuntimeError("lost")
        return real_save(s, spec, root, data, batch_id, *args, **options)

    def broken_finish(self, batch_id, name):
        if step == "after" and batch_id == 1 and name == "clean" and not tries:
            tries.append(1)
            raise RuntimeError("lost")
        real_finish(self, batch_id, name)
    monkeypatch.setattr(runs, "save", broken_save)
    monkeypatch.setattr(pipelines.BatchLedger, "finish", broken_finish)
    with pytest.raises(Exception):
        drain(spark, tmp_path, times, [("fact", fact)])
    assert tries
    drain(spark, tmp_path, times, [("fact", fact)])
    day, later = datetime(1970, 1, 2), datetime(1970, 1, 3, 7, 33, 20)
    raw, clean, loaded = tables_of(spark, tmp_path)
    assert raw == sorted([(k, at, n, seen) for seen, data in zip((T1, T2, T3), BATCHES) for k, at, n in data], key=str)
    assert clean == [(1, day, 1, T3), (1, later, 5, T2), (2, day, 4, T1), (2, later, 6, T3)]
    assert loaded == [(str(k), at, n, seen) for k, at, n, seen in clean]


def test_times_of_micro_batches_grow_and_are_kept(spark, tmp_path):
    ledger = BatchLedger(spark, str(tmp_path / "l"))
    assert [ledger.time_of(0, lambda: T2), ledger.time_of(1, lambda: T1), ledger.time_of(0, lambda: T3)] == [
        T2, T2 + timedelta(microseconds=1), T2]
    ledger.finish(1, "raw")
    assert ledger.done(1, "raw") and not ledger.done(1, "clean") and not ledger.done(0, "raw")
    ledger.trim(keep=1)
    assert ledger.done(1, "raw") and ledger.time_of(2, lambda: T1) == T2 + timedelta(microseconds=2)


def test_upsert_streams_into_declared_tables(spark, tmp_path):
    table = store_of(spark, CLEAN, str(tmp_path))
    handler = upsert_into(table, ["k"])
    for number, data in enumerate([[(1, "a", T1), (25, "b", T1)], [(1, "old", datetime(2023, 1, 1)), (25, "B", T2)]]):
        handler(spark.createDataFrame(data, CLEAN.schema), number)
    assert rows(read_table(spark, CLEAN, str(tmp_path)).select("k", "v")) == [(1, "a"), (25, "B")]


def test_two_current_members_of_a_key_are_refused(spark):
    from stratamart.operators.lookup import key_lookup
    fact = spark.createDataFrame([(1, "a"), (2, None)], "i int, n string")
    members = spark.createDataFrame([("a", "k1"), (None, "k2"), (None, "k3")], "n string, member string")
    assert rows(key_lookup(fact, members, ["n"], "member")) == [(None, 2, "-1"), ("a", 1, "k1")] or rows(
        key_lookup(fact, members, ["n"], "member").select("i", "member")) == [(1, "k1"), (2, "-1")]
    with pytest.raises(PySparkException, match="DuplicateKey"):
        key_lookup(fact, members.union(spark.createDataFrame([("a", "k4")], members.schema)), ["n"], "member").collect()
