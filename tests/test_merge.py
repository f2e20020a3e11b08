import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratamart.operators import pairing
from stratamart.operators.audit import audit_row
from stratamart.operators.dedupe import one_row_per_key
from stratamart.operators.latest import (
    NEVER, incremental, latest_per_key, newer_than, next_sequence, stored_watermarks,
)
from stratamart.operators.lookup import conformed_union, enrich_left, key_lookup, star_join
from stratamart.operators.merge import compared, delete_keys, merge_actions, upsert
from stratamart.operators.lookup import star_join
from stratamart.operators.skew import SALTS, heavy_keys, hot_keys, spread_join

TARGET = [(1, "a", 1), (2, "b", 1), (3, "c", 1)]
BATCH = [(2, "B", 2), (4, "d", 2), (4, "e", 1)]
MERGED = [(1, "a", 1), (2, "B", 2), (3, "c", 1), (4, "d", 2)]
COLUMNS = "k int, v string, ver int"


@pytest.fixture(params=["shuffled", "broadcast"])
def frames(request, spark, monkeypatch):
    """Frames whose merges shuffle both sides, or broadcast the batch."""
    monkeypatch.setattr(pairing, "prefer_broadcast", lambda stored, batch: request.param == "broadcast")
    return lambda data, schema, name: spark.createDataFrame(data, schema)


def test_upsert(frames):
    target, batch = frames(TARGET, COLUMNS, "t"), frames(BATCH, COLUMNS, "b")
    assert rows(upsert(target, batch, ["k"], version="ver")) == MERGED
    assert rows(upsert(target, batch, ["k"], order_by=["ver"])) == MERGED
    assert rows(upsert(target, batch, ["k"], version="ver", key_range="k")) == MERGED


def test_upsert_is_idempotent_and_ignores_older(frames):
    target, batch = frames(TARGET, COLUMNS, "t"), frames(BATCH, COLUMNS, "b")
    once = upsert(target, batch, ["k"], version="ver")
    assert rows(upsert(once, batch, ["k"], version="ver")) == MERGED
    older = frames([(2, "old", 0), (3, "null", None), (1, "same", 1)], COLUMNS, "o")
    assert rows(upsert(once, older, ["k"], version="ver")) == [(1, "same", 1), *MERGED[1:]]


def test_upsert_drops_null_keys_and_reports_duplicates(frames):
    target, batch = frames(TARGET, COLUMNS, "t"), frames([(None, "n", 5), (3, "C", 2)], COLUMNS, "b")
    assert rows(upsert(target, batch, ["k"]))[2] == (3, "C", 2)
    assert upsert(target, batch, ["k"]).count() == 3
    with pytest.raises(PySparkException, match="DuplicateKey"):
        upsert(target, frames(BATCH, COLUMNS, "d"), ["k"], on_duplicate="error").collect()


def test_upsert_into_nothing_and_of_nothing(frames, spark):
    empty = spark.createDataFrame([], COLUMNS)
    batch = frames(BATCH, COLUMNS, "b")
    assert rows(upsert(empty, batch, ["k"], version="ver")) == [(2, "B", 2), (4, "d", 2)]
    assert rows(upsert(frames(TARGET, COLUMNS, "t"), empty, ["k"], version="ver")) == TARGET


def test_delete(frames):
    gone = frames([(2,), (None,), (9,)], "k int", "g")
    assert rows(delete_keys(frames(TARGET, COLUMNS, "t"), gone, ["k"])) == [TARGET[0], TARGET[2]]


def test_actions_and_audit(frames):
    target = frames([(1, "a", 1), (2, "b", 1), (3, "c", 5)], COLUMNS, "t")
    batch = frames([(2, "B", 2), (3, "old", 4), (4, "d", 2), (4, "e", 1)], COLUMNS, "b")
    gone = frames([(1,), (8,)], "k int", "g")
    actions = merge_actions(target, batch, ["k"], version="ver", deletes=gone)
    assert rows(actions) == [(1, "delete"), (2, "update"), (3, "ignore"), (4, "insert")]
    row = audit_row(actions, "t", datetime(2024, 1, 1), ("insert", "update", "ignore", "delete", "close"))
    assert rows(row) == [("t", datetime(2024, 1, 1), 1, 1, 1, 1, 0)]


def test_dedupe_is_independent_of_partitioning(spark):
    rng = random.Random(5)
    data = [(rng.randrange(20), rng.randrange(3), rng.choice([None, "x", "y"])) for _ in range(500)]
    expected = {}
    for k, n, v in data:
        best = expected.get(k)
        rank = (n, v is not None, v or "")
        if best is None or rank > best[0]:
            expected[k] = (rank, (k, n, v))
    for parts in (1, 7):
        df = spark.createDataFrame(data, "k int, n int, v string").repartition(parts)
        assert sorted(map(str, rows(one_row_per_key(df, ["k"], ["n"])))) == sorted(
            str(v) for _, v in expected.values())


def test_dedupe_combines_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id")
    plan = one_row_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("counted", [False, True])
def test_salted_join_equals_plain(spark, no_broadcast, how, counted):
    rng = random.Random(11)
    # One key has a third of the rows, NULL another tenth, and some rows are exact copies.
    left = [(7 if rng.random() < 0.33 else rng.randrange(40) if rng.random() < 0.9 else None, i % 50)
            for i in range(900)]
    right = [(k, f"r{k}") for k in range(0, 40, 2)] + [(7, "r7"), (7, "again"), (None, "null")]
    a = spark.createDataFrame(left, "k int, i int").repartition(5)
    b = spark.createDataFrame(right, "k int, r string")
    salted = spread_join(a, b, ["k"], how, hot_rows=100, counted=a.select("k") if counted else None,
                         force_salting=True)
    plain = a.join(b, ["k"], how)
    assert salted.columns == plain.columns and rows(salted) == rows(plain)


def test_hot_rows_are_spread(spark, no_broadcast):
    left = spark.range(2000).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, r string")
    assert rows(hot_keys(left, ["k"], 100)) == [(1,)]
    joined = spread_join(left, right, ["k"], hot_rows=100, force_salting=True)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan
    from stratamart.operators.skew import _spread
    assert left.select(F.pmod(_spread(left), F.lit(SALTS)).alias("s")).distinct().count() == SALTS


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        spread_join(spark.range(1), spark.range(1), ["id"], "full_outer")


def test_latest_keeps_ties(spark, small_inputs_skew):
    data = [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "d")]
    df = spark.createDataFrame(data, "k int, t int, v string")
    assert rows(latest_per_key(df, ["k"], "t")) == data[1:]
    assert rows(latest_per_key(df, ["k"], "t", hot_rows=1)) == data[1:]
    assert rows(latest_per_key(df, ["k"], "t", unique=True)) == data[2:]


def test_watermarks(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    data = [("a", i, t0 + timedelta(days=i)) for i in range(5)] + [("b", 9, t0)]
    df = spark.createDataFrame(data, "tag string, id int, ingest_ts timestamp")
    loaded = stored_watermarks(df, "tag", "ingest_ts", ["a", "b", "c"])
    assert loaded == {"a": t0 + timedelta(days=4), "b": t0, "c": NEVER}
    # Strictly newer: a row with the watermark's own timestamp counts as loaded.
    assert newer_than(df, t0).count() == 4
    assert newer_than(df, t0 + timedelta(days=1), lookback=timedelta(days=2)).count() == 6
    df.write.parquet(f"{tmp_path}/w")
    files = spark.read.parquet(f"{tmp_path}/w")
    plan = newer_than(files, t0)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ingest_ts" in plan
    assert incremental({"a": files}, {})["a"].count() == 6


def test_next_sequence(spark):
    df = spark.createDataFrame([("3",), ("x",), (None,)], "n string")
    assert rows(next_sequence(df, "n")) == [(4,)]
    assert rows(next_sequence(df.filter("n = 'x'"), "n")) == [(1,)]
    assert rows(next_sequence(df.limit(0), "n")) == [(1,)]


def test_lookup_star_and_union(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, nat string")
    dim = spark.createDataFrame(
        [("a", "old", "x", False), ("a", "key-a", "y", True)],
        "nat string, dim_key string, label string, scd_is_current boolean")
    looked_up = key_lookup(fact, dim, ["nat"], "dim_key")
    assert rows(looked_up.select("id", "dim_key")) == [(1, "key-a"), (2, "-1"), (3, "-1")]
    star = star_join(looked_up, {"dim_key": dim.select("dim_key", "label", "scd_is_current")})
    assert rows(star.select("id", "label")) == [(1, "y")]
    extra = spark.createDataFrame([("a", 1, "n"), ("a", 2, "m")], "nat string, v int, note string")
    assert enrich_left(fact, extra, ["nat"]).count() == 4
    assert rows(enrich_left(fact, extra, ["nat"], dedupe_right=["v"]).select("id", "note")) == [
        (1, "m"), (2, None), (3, None)]
    both = conformed_union({"x": fact, "y": fact}, "src", ["src", "id"])
    assert both.count() == 6 and both.columns == ["src", "id"]


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(2_000_000).selectExpr("id as k", "xxhash64(id) as v", "1 as ver").write.parquet(f"{tmp_path}/t")
    spark.range(10).selectExpr("id as k", "0L as v", "2 as ver").write.parquet(f"{tmp_path}/b")
    target, batch = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/b")
    for options in ({"version": "ver"}, {}):
        merged = upsert(target, batch, ["k"], unique=True, **options)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        assert merged.count() == 2_000_000


def test_small_dimension_is_broadcast(spark, tmp_path):
    spark.range(10).selectExpr("id as k", "id as label").write.parquet(f"{tmp_path}/d")
    fact = spark.range(100).selectExpr("id % 10 as k", "id")
    star = star_join(fact, {"k": spark.read.parquet(f"{tmp_path}/d")})
    assert "BroadcastHashJoin" in star._jdf.queryExecution().executedPlan().toString()


def test_more_than_a_thousand_hot_keys(spark, no_broadcast, small_inputs_skew):
    """Each hot key gets parts by its rows, and all keys of a star are found in one job."""
    left = spark.range(1500).select(F.col("id").cast("int").alias("k"), (F.col("id") % 7).alias("m"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"))
    left = left.unionByName(spark.range(5000).select(F.lit(3).cast("int").alias("k"), F.lit(None).cast("long").alias("m"), F.col("id").cast("int").alias("i")))
    heavy = heavy_keys(left, {"k": ["k"], "m": ["m"], "both": ["k", "m"]}, 4)
    sizes = {r[0]: r[1] for r in heavy["k"].collect()}
    assert len(sizes) == 1500 and max(sizes.values()) >= 1200 and heavy["m"].count() == 7 and heavy["both"].count() == 1500
    right = spark.range(0, 1600, 2).select("id", F.concat(F.lit("r"), F.col("id").cast("string")).alias("r")).withColumnRenamed("id", "k")
    joined = spread_join(left, right, ["k"], "left", hot_rows=4, force_salting=True)
    assert rows(joined) == rows(left.join(right, "k", "left").select(*joined.columns))
    spark.sparkContext.setJobGroup("star", "star")
    star = star_join(left, {"k": right, "m": spark.range(7).select(F.col("id").alias("m"), F.lit(1).alias("x"))}, hot_rows=4)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("star"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plain = left.join(right, "k").join(spark.range(7).select(F.col("id").alias("m"), F.lit(1).alias("x")), "m")
    assert jobs <= 2 and rows(star) == rows(plain.select(*star.columns))


def test_keys_of_unlike_types_and_zeros_meet(spark, no_broadcast):
    left = spark.createDataFrame([(0.0,), (-0.0,), (1.5,), (None,)] * 30, "k double")
    right = spark.createDataFrame([(0.0, "zero"), (1.5, "x")], "k double, r string")
    assert spread_join(left, right, ["k"], hot_rows=5, force_salting=True).count() == 90
    ints = spark.createDataFrame([(1,)] * 50 + [(2,)], "k int")
    longs = spark.createDataFrame([(1, "a"), (2, "b"), (1 << 40, "c")], "k long, r string")
    assert spread_join(ints, longs, ["k"], hot_rows=5, force_salting=True).count() == 51


def test_packed_keys_stay_apart_and_come_back(spark):
    from stratamart.functions.keys import packed, unpacked

    digits = "0123456789abcdef" * 4
    keys = [None, "", "-1", digits, digits.upper(), digits[:-1], digits + "\n", "41", "A", "\u00e9"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed(F.col("k")).alias("p"))
    got = df.select("k", unpacked(F.col("p")).alias("back"), F.length("p").alias("n"), F.hex("p").alias("h")).collect()
    assert all(r["k"] == r["back"] for r in got) and len({r["h"] for r in got}) == len(keys)
    assert {r["n"] for r in got if r["k"] == digits} == {33}


def test_a_large_dimension_is_joined_by_packed_keys_after_the_small_ones(spark, no_broadcast, small_inputs_skew, tmp_path):
    digits = "0123456789abcdef" * 4
    fact = spark.createDataFrame([(digits, "x", 1), ("-1", "y", 2), (None, "x", 3), ("gone", "x", 4)], "big string, small string, n int")
    big = spark.createDataFrame([(digits, "B"), ("-1", "U")], "big string, b string")
    small = spark.createDataFrame([("x", "X"), ("y", "Y")], "small string, s string")
    got = star_join(fact, {"big": big, "small": small})
    assert rows(got.select("big", "small", "n", "b", "s")) == [("-1", "y", 2, "U", "Y"), (digits, "x", 1, "B", "X")]
    assert sorted(got.columns) == ["b", "big", "n", "s", "small"]
    assert "unhex" in got._jdf.queryExecution().optimizedPlan().toString()
    left = star_join(fact, {"big": big, "small": small}, how="left").select("big", "n", "b", "s")
    assert rows(left) == [(None, 3, None, "X"), ("-1", 2, "U", "Y"), (digits, 1, "B", "X"), ("gone", 4, None, "X")]


def test_keys_are_compared_packed(spark):
    digits = "0123456789abcdef" * 4
    stored = spark.createDataFrame([(digits, 1), ("41", 1), ("", 1), ("kept", 1)], "k string, v int")
    batch = spark.createDataFrame([(digits, 2), (digits.upper(), 2), ("A", 2), ("", 0), (None, 2), ("A", 3)], "k string, v int")
    assert compared(stored, batch, ["k"], "v") == {
        "read": 6, "rejected": 1, "repeated": 1, "insert": 2, "update": 1, "ignore": 1, "keep": 2}
    numbers = spark.createDataFrame([(7,)], "k int")
    assert compared(numbers, numbers, ["k"])["update"] == 1
