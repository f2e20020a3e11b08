import os
import shutil
import uuid
from dataclasses import replace
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratamart.operators.conform import IncompatibleSchema, merged_schema, stamp
from stratamart.plans.dimensions import DATE_MODEL, DIM_DATE, date_dimension, generate_dimension
from stratamart.plans.runs import read_table, run_model, run_pipeline, save
from stratamart.sources import tables
from stratamart.sources.files import move_files
from stratamart.sources.tables import PartitionedTable, SnapshotTable, append_batch, read_or_empty, scratch_dir, staged
from stratamart.spec import INGEST_TS, Model, Pipeline, SaveMode, TableSpec, schema_of, with_ingest_ts

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
KV = schema_of({"k": "integer", "v": "string"}, required=("k",))


def files_under(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_append_is_safe_to_repeat(spark, tmp_path):
    path = str(tmp_path / "raw")
    for at, data in ((T1, [(1, "a")]), (T2, [(1, "b")]), (T2, [(1, "b")])):
        append_batch(stamp(spark.createDataFrame(data, KV), at), path, [INGEST_TS])
    assert rows(spark.read.parquet(path).select("k", "v")) == [(1, "a"), (1, "b")]


def test_missing_table_is_empty(spark, tmp_path):
    assert read_or_empty(spark, str(tmp_path / "none"), KV).count() == 0
    assert SnapshotTable(spark, str(tmp_path / "none"), KV).read().count() == 0
    assert PartitionedTable(spark, str(tmp_path / "none"), ["k"], KV).read().count() == 0


def test_incomplete_snapshot_is_ignored(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), KV)
    table.merge(spark.createDataFrame([(1, "a")], KV), ["k"], 0)
    table.merge(spark.createDataFrame([(2, "b")], KV), ["k"], 1)
    os.remove(tmp_path / "t" / "v=1" / "_SUCCESS")
    assert table.versions() == [0] and rows(table.read()) == [(1, "a")]
    # The lost run is repeated under its own number.
    table.merge(spark.createDataFrame([(2, "b")], KV), ["k"], 1)
    assert rows(table.read()) == [(1, "a"), (2, "b")] and rows(table.read(0)) == [(1, "a")]


def test_replay_starts_from_the_version_before(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), KV)
    for number, data in ((0, [(1, "a"), (2, "b")]), (1, [(3, "c")]), (1, [(1, "A")])):
        table.merge(spark.createDataFrame(data, KV), ["k"], number)
    assert rows(table.read()) == [(1, "A"), (2, "b")]


def test_pruned_merge_leaves_other_partitions_alone(spark, tmp_path):
    schema = schema_of({"k": "integer", "v": "string", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema)
    table.merge(spark.createDataFrame([(1, "a", "01"), (2, "b", "01"), (3, "c", "02")], schema), ["k"])
    before = files_under(tmp_path / "t" / "p=02")
    batch = spark.createDataFrame([(2, "B", "01"), (4, "d", "03")], schema)
    touched = table.touched(batch)
    assert "PartitionFilters: [p" in touched._jdf.queryExecution().executedPlan().toString()
    table.merge(batch, ["k"])
    assert files_under(tmp_path / "t" / "p=02") == before
    # Partition values keep their declared type although '01' looks like a number.
    assert rows(table.read()) == [(1, "a", "01"), (2, "B", "01"), (3, "c", "02"), (4, "d", "03")]
    moved = spark.createDataFrame([(3, "x", "01"), (1, "y", "01")], schema)
    assert rows(table.moved_keys(moved, ["k"])) == [(3, "01", "02")]


def test_many_partitions_are_listed(spark, tmp_path):
    """Thousands of partitions, with deletes: the filter is a list of literals at any number."""
    schema = schema_of({"k": "integer", "v": "string", "p": "integer"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema)
    table.merge(spark.range(2_300).selectExpr("int(id) k", "'a' v", "int(id % 2200) p").repartition(2), ["k"])
    batch = spark.range(2_150).selectExpr("int(id) k", "'b' v", "int(id) p")
    touched = table.touched(batch)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [p" in plan and "Join" not in plan
    table.merge(batch, ["k"], deletes=spark.createDataFrame([(2_199,), (5,), (2_160,)], "k int"))
    got = table.read().groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {"b": 2_149, "a": 148}
    assert not os.path.exists(tmp_path / "t" / "p=2199") and not os.path.exists(tmp_path / "t" / "p=2160")
    assert os.path.exists(tmp_path / "t" / "p=5")


def test_null_and_empty_partitions_keep_their_rows(spark, tmp_path):
    schema = schema_of({"k": "integer", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema)
    table.merge(spark.createDataFrame([(1, None), (2, ""), (3, "x"), (9, None)], schema), ["k"])
    table.merge(spark.createDataFrame([(4, None)], schema), ["k"])
    table.merge(spark.createDataFrame([(2, "")], schema), ["k"], deletes=spark.createDataFrame([(9,)], "k int"))
    assert rows(table.read()) == [(1, None), (2, None), (3, "x"), (4, None)]
    table.merge(spark.createDataFrame([(3, "x")], schema), ["k"], deletes=spark.createDataFrame([(1,), (2,), (4,)], "k int"))
    assert rows(table.read()) == [(3, "x")]

    pairs = schema_of({"k": "integer", "p": "integer", "q": "string"})
    two = PartitionedTable(spark, str(tmp_path / "two"), ["p", "q"], pairs)
    two.merge(spark.createDataFrame([(1, None, "a"), (2, 1, None), (3, 1, "a"), (4, None, None)], pairs), ["k"])
    two.merge(spark.createDataFrame([(5, None, "a"), (6, 1, None)], pairs), ["k"], deletes=spark.createDataFrame([(4,)], "k int"))
    assert rows(two.read()) == [(1, None, "a"), (2, 1, None), (3, 1, "a"), (5, None, "a"), (6, 1, None)]


def test_moved_keys_are_refused(spark, tmp_path):
    schema = schema_of({"k": "integer", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema)
    table.merge(spark.createDataFrame([(1, "x"), (2, None)], schema), ["k"])
    for moved in ((1, "y"), (1, None), (2, "x")):
        with pytest.raises(tables.MovedKeys):
            table.merge(spark.createDataFrame([moved], schema), ["k"])
    assert rows(table.read()) == [(1, "x"), (2, None)]


def test_a_broken_commit_is_finished_by_the_next_merge(spark, tmp_path, monkeypatch):
    schema = schema_of({"k": "integer", "v": "string", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema)
    table.merge(spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], schema), ["k"])
    written = tables.write_files

    def broken(df, path, **options):
        if path == table.path:  # the old partition is gone, the new one not there yet
            shutil.rmtree(tmp_path / "t" / "p=x")
            raise RuntimeError("lost")
        written(df, path, **options)
    monkeypatch.setattr(tables, "write_files", broken)
    with pytest.raises(RuntimeError, match="lost"):
        table.merge(spark.createDataFrame([(4, "d", "x")], schema), ["k"], deletes=spark.createDataFrame([(2,)], "k int"))
    monkeypatch.setattr(tables, "write_files", written)
    table.merge(spark.createDataFrame([(5, "e", "z")], schema), ["k"])
    assert rows(table.read()) == [(1, "a", "x"), (3, "c", "z"), (4, "d", "x"), (5, "e", "z")]
    assert not table.recover() and not os.path.exists(tmp_path / "t-pending")


def test_an_older_batch_is_refused(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), KV)
    for number in (0, 1):
        table.merge(spark.createDataFrame([(1, str(number))], KV), ["k"], number)
    with pytest.raises(tables.OutOfOrder):
        table.merge(spark.createDataFrame([(1, "again")], KV), ["k"], 0)


def test_versions_stay_few(spark, tmp_path):
    snapshots, history = SnapshotTable(spark, str(tmp_path / "s"), KV), tables.Scd2Table(spark, str(tmp_path / "h"), KV)
    for number in range(7):
        batch = spark.createDataFrame([(1, str(number // 2)), (2, str(number))], KV)
        at = datetime(2024, 1, 1 + number)
        snapshots.merge(batch, ["k"], number)
        history.apply(batch, ["k"], ["v"], number, at)
        snapshots.expire()
        history.expire()
        assert len(snapshots.versions()) <= 2 and len(history.versions()) <= 2
        assert len(os.listdir(tmp_path / "h" / "closed") if os.path.exists(tmp_path / "h" / "closed") else []) <= 1
    assert rows(snapshots.read()) == [(1, "3"), (2, "6")]
    closed = history.history().filter("not scd_is_current").select("k", "v").collect()
    assert sorted(map(tuple, closed)) == [(1, str(i)) for i in range(3)] + [(2, str(i)) for i in range(6)]
    assert history.history().filter("scd_is_current").count() == 2


def test_new_source_columns_reach_both_layers(spark, tmp_path):
    root = str(tmp_path)
    raw = TableSpec("raw_t", "bronze", with_ingest_ts(KV), SaveMode.APPEND, ("k",), partition_by=(INGEST_TS,))
    clean = TableSpec("t", "silver", with_ingest_ts(KV), SaveMode.MERGE, ("k",))
    first = Pipeline("p", raw, clean, lambda s: s.createDataFrame([(1, "a")], KV))
    second = Pipeline("p", raw, clean, lambda s: s.createDataFrame([(2, "b", 5)], "k int, v string, extra long"))
    run_pipeline(spark, first, root, 0, T1)
    run_pipeline(spark, second, root, 1, T2)
    for spec in (raw, clean):
        assert rows(read_table(spark, spec, root).select("k", "v", "extra")) == [(1, "a", None), (2, "b", 5)]
    fixed = replace(raw, name="raw_f", evolve=False), replace(clean, name="f", evolve=False)
    run_pipeline(spark, Pipeline("p", *fixed, second.source), root, 0, T1)
    assert "extra" not in read_table(spark, fixed[0], root).columns + read_table(spark, fixed[1], root).columns


@pytest.mark.parametrize("narrow,wide", [("byte", "short"), ("byte", "int"), ("byte", "long"), ("short", "int"), ("short", "long"),
                                         ("int", "long"), ("int", "double"), ("float", "double"), ("decimal(5,2)", "decimal(9,3)")])
def test_stored_files_serve_wider_types(spark, tmp_path, narrow, wide):
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], spark.range(0).selectExpr("id k", f"cast(1 as {narrow}) v", "int(1) p").schema,
                             evolving=True)
    table.merge(spark.range(1).selectExpr("id k", f"cast(1.5 as {narrow}) v", "int(1) p"), ["k"])
    table.merge(spark.range(1, 2).selectExpr("id k", f"cast(2 as {wide}) v", "int(2) p"), ["k"])
    assert [float(r["v"]) for r in table.read().orderBy("k").collect()] == [1.5 if "d" in narrow or narrow == "float" else 1.0, 2.0]


def test_dates_do_not_become_timestamps():
    with pytest.raises(IncompatibleSchema):
        merged_schema(schema_of({"d": "date"}), schema_of({"d": "timestamp"}))


def test_two_partition_columns_and_deletes(spark, tmp_path):
    schema = schema_of({"k": "integer", "v": "string", "p": "integer", "q": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p", "q"], schema)
    table.merge(spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 1, "x"), (3, "c", 2, "y")], schema), ["k"])
    table.merge(spark.createDataFrame([(1, "A", 1, "x")], schema), ["k"], deletes=spark.createDataFrame([(2,)], "k int"))
    assert rows(table.read()) == [(1, "A", 1, "x"), (3, "c", 2, "y")]


def test_deletes_reach_other_partitions(spark, tmp_path):
    schema = schema_of({"k": "integer", "v": "string", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema)
    table.merge(spark.createDataFrame([(1, "a", "x:1"), (2, "b", "y"), (3, "c", "y"), (4, "d", "z")], schema), ["k"])
    untouched = files_under(tmp_path / "t" / "p=z")
    # Key 1 is the last row of its partition, key 2 is not, and the batch is in neither partition.
    gone = spark.createDataFrame([(1,), (2,)], "k int")
    table.merge(spark.createDataFrame([(5, "e", "w")], schema), ["k"], deletes=gone)
    assert rows(table.read()) == [(3, "c", "y"), (4, "d", "z"), (5, "e", "w")]
    assert files_under(tmp_path / "t" / "p=z") == untouched


def test_evolving_partitioned_table(spark, tmp_path):
    schema = schema_of({"k": "integer", "p": "integer"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema, evolving=True)
    table.merge(spark.createDataFrame([(1, 1), (2, 2)], schema), ["k"])
    table.merge(spark.createDataFrame([(3, 2, "n")], "k int, p int, note string"), ["k"])
    assert rows(table.read()) == [(1, 1, None), (2, 2, None), (3, 2, "n")]
    table.merge(spark.createDataFrame([(4, 5)], "k int, p int"), ["k"])
    assert table.read().count() == 4 and table.evolved.versions() == [0]


def test_key_blocks(spark, tmp_path):
    root = str(tmp_path)
    schema = schema_of({"k": "long", "v": "string"}, required=("k",))
    spec = TableSpec("t", "silver", schema, SaveMode.MERGE, ("k",), key_blocks=("k", 10))
    save(spark, spec, root, spark.createDataFrame([(1, "a"), (12, "b"), (25, "c")], schema), 0, T1)
    before = files_under(tmp_path / "silver" / "t" / "key_block=0")
    save(spark, spec, root, spark.createDataFrame([(25, "C"), (31, "d")], schema), 1, T2)
    assert rows(read_table(spark, spec, root)) == [(1, "a"), (12, "b"), (25, "C"), (31, "d")]
    assert before and files_under(tmp_path / "silver" / "t" / "key_block=0") == before


def test_file_size_and_codec(spark, tmp_path):
    df = spark.range(400_000).withColumn("x", F.xxhash64("id"))
    tables.write_files(df, str(tmp_path / "small"), rebalance=True, target_file_bytes=500_000)
    tables.write_files(df, str(tmp_path / "large"), rebalance=True)
    small, large = files_under(tmp_path / "small"), files_under(tmp_path / "large")
    assert len(small) > len(large) and all(f.endswith(".snappy.parquet") for f in small | large)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") not in ("500000", "100000000")


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark)
    assert path != scratch_dir(spark) and (shared is None or path.startswith(shared))
    assert staged(spark.range(3), path).count() == 3


def test_pipeline_contract(spark, tmp_path):
    root = str(tmp_path)
    raw = TableSpec("things", "bronze", with_ingest_ts(KV), SaveMode.APPEND, ("k",), partition_by=(INGEST_TS,))
    clean = TableSpec("things", "silver", with_ingest_ts(KV), SaveMode.MERGE, ("k",), version_column=INGEST_TS)
    data = {0: [(1, "a"), (2, "b")], 1: [(2, "B"), (3, "c")]}

    def pipeline(n):
        return Pipeline("things", raw, clean, lambda s: s.createDataFrame(data[n], KV),
                        lambda df: df.withColumn("v", F.upper("v")),
                        (lambda s: s.createDataFrame([(1,)], "k int")) if n else None)

    for number, at in ((0, T1), (1, T2), (1, T2)):
        run_pipeline(spark, pipeline(number), root, number, at)
    assert rows(read_table(spark, raw, root).select("k", "v")) == [(1, "a"), (2, "B"), (2, "b"), (3, "c")]
    assert rows(read_table(spark, clean, root)) == [(2, "B", T2), (3, "C", T2)]


def test_model_contract(spark, tmp_path):
    root = str(tmp_path)
    assert read_table(spark, DIM_DATE, root).count() == 0
    for number in (0, 1):
        run_model(spark, DATE_MODEL, root, number, T1, spark=spark, start=T1.date(), end=T2.date())
    dates = read_table(spark, DIM_DATE, root)
    assert dates.count() == 32 and dates.columns == DIM_DATE.columns
    assert date_dimension(spark, T1.date(), T1.date(), T1).count() == 1


def test_dimension_keys_by_content_or_nature(spark, tmp_path):
    data = [("P1", "old", T1), ("P1", "new", T2), ("P1", "new", T3), (None, None, T1)]
    source = spark.createDataFrame(data, "id string, label string, ingest_ts timestamp")

    def make(key_of):
        return generate_dimension(source, ["id", "label"], ["id"], "key", T3, key_of=key_of)

    natural, content = make("natural"), make("content")
    assert natural.count() == content.count() == 3
    assert natural.select("key").distinct().count() == 2 and content.select("key").distinct().count() == 3
    assert rows(natural.filter("key = '-1'").select("id", "label")) == [("unknown", "unknown")]
    spec = TableSpec("dim", "gold", natural.schema, SaveMode.MERGE_SCD2, ("key",), change_columns=("id", "label"))
    model = Model(spec, lambda rows_, batch_ts: generate_dimension(rows_, ["id", "label"], ["id"], "key", batch_ts))
    run_model(spark, model, str(tmp_path), 0, T1, rows_=source.filter(F.col(INGEST_TS) <= F.lit(T1)))
    run_model(spark, model, str(tmp_path), 1, T3, rows_=source)
    history = read_table(spark, spec, str(tmp_path))
    assert rows(history.filter("id = 'P1'").select("label", "scd_is_current")) == [("new", True), ("old", False)]


def test_a_batch_that_replaces_all_or_adds_only_is_not_joined(spark, tmp_path, monkeypatch):
    """Keys tell what a merge does; whole rows are joined only where some stored rows stay and others go."""
    from stratamart.operators.audit import LoadCounts

    def never(*args, **options):
        raise AssertionError("whole rows joined")
    schema = schema_of({"k": "integer", "v": "string", "at": "integer", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema, follows_key=True)
    joined, counts = tables.upsert, []

    def merge(number, data):
        counts.append(LoadCounts())
        table.merge(spark.createDataFrame(data, schema), ["k"], number, version="at", counts=counts[-1])
        got = counts[-1].values()
        return tuple(got[f"rows_{c}"] for c in ("read", "rejected", "insert", "update", "ignore"))
    monkeypatch.setattr(tables, "upsert", never)
    assert merge(0, [(1, "a", 1, "x"), (2, "b", 1, "y"), (None, "n", 1, "x")]) == (3, 1, 2, 0, 0)
    assert merge(1, [(3, "c", 1, "x")]) == (1, 0, 1, 0, 0)
    assert merge(2, [(1, "A", 2, "x"), (3, "C", 1, "x"), (4, "D", 1, "x")]) == (3, 0, 1, 2, 0)
    assert rows(table.read()) == [(1, "A", 2, "x"), (2, "b", 1, "y"), (3, "C", 1, "x"), (4, "D", 1, "x")]
    for data in ([(1, "old", 1, "x")], [(2, "r", 3, "y"), (2, "s", 4, "y")], [(1, "n", 5, "x"), (9, "n", 5, "x")]):
        with pytest.raises(AssertionError, match="whole rows"):
            merge(3, data)
    monkeypatch.setattr(tables, "upsert", joined)
    assert merge(3, [(1, "old", 1, "x"), (2, "r", 3, "y"), (2, "s", 4, "y"), (9, "n", 5, "x")]) == (4, 0, 1, 1, 1)
    assert rows(table.read()) == [(1, "A", 2, "x"), (2, "s", 4, "y"), (3, "C", 1, "x"), (4, "D", 1, "x"), (9, "n", 5, "x")]


def test_new_keys_are_added_without_a_copy_of_the_stored_rows(spark, tmp_path):
    schema = schema_of({"k": "integer", "v": "string", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema, follows_key=True)

    def merge(number, data, **options):
        table.merge(spark.createDataFrame(data, schema), ["k"], number, **options)
        return files_under(tmp_path / "t")

    first = merge(0, [(k, "a", "x") for k in range(20)] + [(100, "a", None)])
    second = merge(1, [(k, "b", "x") for k in range(20, 25)] + [(101, "b", None), (None, "b", "x")])
    assert first < second
    # Repeating a batch replaces its rows, as does one with a key that is stored; a small one is written with the stored rows.
    again = merge(1, [(k, "b", "x") for k in range(20, 25)] + [(101, "b", None)])
    mixed = merge(2, [(0, "c", "x"), (25, "c", "x")])
    small = merge(3, [(26, "d", "x")])
    assert not again & {f for f in second if "p=x" in f} and not mixed & {f for f in again if "p=x" in f}
    assert not small & {f for f in mixed if "p=x" in f}
    expected = {k: "a" for k in [*range(1, 20), 100]} | {k: "b" for k in [*range(20, 25), 101]} | {0: "c", 25: "c", 26: "d"}
    assert {r["k"]: r["v"] for r in table.read().collect()} == expected and table.read().count() == len(expected)


def test_added_files_that_were_moved_in_part_are_moved_on(spark, tmp_path, monkeypatch):
    schema = schema_of({"k": "integer", "p": "string"})
    table = PartitionedTable(spark, str(tmp_path / "t"), ["p"], schema, follows_key=True)
    table.merge(spark.createDataFrame([(1, "x"), (2, "y")], schema), ["k"], 0)
    moved = []

    def breaks_off(session, source, target):
        if moved:
            raise RuntimeError("lost")
        moved.append(source)
        move_files(session, source, target)

    monkeypatch.setattr(tables, "move_files", breaks_off)
    with pytest.raises(RuntimeError, match="lost"):
        table.merge(spark.createDataFrame([(3, "x"), (4, "y")], schema), ["k"], 1)
    monkeypatch.undo()
    assert table.read().count() == 3 and table.applied() == 0
    assert table.recover() and not table.recover()
    assert rows(table.read()) == [(1, "x"), (2, "y"), (3, "x"), (4, "y")] and table.applied() == 1


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getPath() for i in range(files.size()) if "shuffle_" in files.apply(i).getName()}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(name)
    df = staged(spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count(), str(tmp_path / "t"))
    assert df.count() == 1000 and not {f for f in shuffled() - before if os.path.getsize(f) > 10_000}
    assert spark.conf.get(name) == setting and all(f.endswith(".zstd.parquet") for f in files_under(tmp_path / "t"))


def test_what_has_arrived_is_not_kept(spark, tmp_path, monkeypatch):
    """The copy of all sales goes before the second load of the fact."""
    from conftest import SMALL

    from stratamart.registry import facts

    for module in (tables, facts):
        monkeypatch.setattr(module, "scratch_dir", lambda spark: f"{tmp_path}/{uuid.uuid4().hex}")
    assert facts.fact_sales_incremental(spark, SMALL).count() > 0
    copies = {os.path.dirname(f) for f in files_under(tmp_path) if f.endswith(".zstd.parquet")}
    assert copies and not [d for d in copies if "customer_name" in spark.read.parquet(d).columns]
