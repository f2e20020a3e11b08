from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from stratamart.sources.tables import Scd2Table, SnapshotTable
from stratamart.spec import INGEST_TS
from stratamart.streaming.micro_batch import STREAM_BATCH, into_raw, landed_stream, scd2_into, start, upsert_into

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
SCHEMA = "k int, v string, ingest_ts timestamp"
DATA = [(T1, [(1, "x"), (2, None), (3, "z")]), (T2, [(1, None), (2, None)]), (T3, [(1, "x"), (2, "y")])]


def land(spark, path, batches):
    for at, data in batches:
        df = spark.createDataFrame([(k, v, at) for k, v in data], SCHEMA)
        df.coalesce(1).write.mode("append").json(path)


def drain(spark, tmp_path, handler, checkpoint="c", max_files=1):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = landed_stream(spark, str(tmp_path / "landing"), schema, max_files=max_files)
    start(stream, into_raw(str(tmp_path / "raw"), handler), str(tmp_path / checkpoint), every=None).awaitTermination()


def test_stream_equals_batch_in_any_order(spark, tmp_path):
    land(spark, str(tmp_path / "landing"), reversed(DATA))
    table = SnapshotTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema)
    drain(spark, tmp_path, upsert_into(table, ["k"]))
    expected = [(1, "x", T3), (2, "y", T3), (3, "z", T1)]
    assert rows(table.read()) == expected and table.versions() == [0, 1, 2]
    # Everything has been read; a new start finds nothing.
    drain(spark, tmp_path, upsert_into(table, ["k"]))
    assert table.versions() == [0, 1, 2]
    # A micro-batch that is run again leaves the table and the raw rows as they were.
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert raw.count() == 7
    last = spark.read.parquet(str(tmp_path / "raw" / f"{STREAM_BATCH}=2"))
    into_raw(str(tmp_path / "raw2"), upsert_into(table, ["k"]))(last, 2)
    assert rows(table.read()) == expected


def test_stream_continues_after_a_stop(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema)
    for part in (DATA[:2], DATA[2:]):
        land(spark, str(tmp_path / "landing"), part)
        drain(spark, tmp_path, upsert_into(table, ["k"]))
    assert rows(table.read()) == [(1, "x", T3), (2, "y", T3), (3, "z", T1)]


def test_stream_scd2_with_several_batches_per_trigger(spark, tmp_path):
    land(spark, str(tmp_path / "landing"), DATA)
    table = Scd2Table(spark, str(tmp_path / "t"))
    drain(spark, tmp_path, scd2_into(table, ["k"], ["v"]), max_files=2)
    assert table.history().count() == 6
    assert rows(table.current().select("k", "v")) == [(1, "x"), (2, "y"), (3, "z")]
    assert table.history().filter(F.col("k") == 1).count() == 3


def test_upsert_transform(spark, tmp_path):
    land(spark, str(tmp_path / "landing"), DATA[:1])
    table = SnapshotTable(spark, str(tmp_path / "t"))
    handler = upsert_into(table, ["k"], transform=lambda df: df.select("k", F.upper("v").alias("v"), INGEST_TS))
    drain(spark, tmp_path, handler)
    assert rows(table.read().select("v")) == [(None,), ("X",), ("Z",)]


def test_a_late_file_does_not_stop_a_type_2_stream(spark, tmp_path):
    table, raw = Scd2Table(spark, str(tmp_path / "t")), str(tmp_path / "raw")
    for part in ([DATA[0]], [DATA[2]], [DATA[1]]):
        land(spark, str(tmp_path / "landing"), part)
        drain(spark, tmp_path, scd2_into(table, ["k"], ["v"], raw_path=raw))
    history = {(r["k"], r["v"], r["scd_start_ts"], r["scd_end_ts"]) for r in table.history().collect()}
    assert history == {(1, "x", T1, T2), (1, None, T2, T3), (1, "x", T3, None), (2, None, T1, T3), (2, "y", T3, None),
                       (3, "z", T1, None)}


def test_what_lands_together_is_one_micro_batch(spark, tmp_path):
    """However many files it is: a micro-batch for each would rewrite the tables as often, and run out of ingest times."""
    from stratamart.registry.streams import _arrive

    batches = [spark.createDataFrame([(k, "x", at) for k in range(40)], SCHEMA).repartition(4) for at in (T1, T2)]
    path, seen = str(tmp_path / "landing"), []
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _arrive(spark, path, batches[0].schema, [[batches[0]], [batches[1]]],
                lambda batch, number: seen.append((number, batch.count())))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert seen == [(0, 40), (1, 40)] and len(list((tmp_path / "landing").glob("part-*"))) > 2
