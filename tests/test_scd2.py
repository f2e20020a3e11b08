import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratamart.operators import pairing
from stratamart.operators.audit import LoadCounts
from stratamart.operators.scd2 import apply_scd2, paired_actions, rebuild_scd2
from stratamart.sources import tables
from stratamart.sources.tables import Scd2Table
from stratamart.spec import SCD_CURRENT, SCD_END, SCD_START

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
BATCHES = [
    (T1, [(1, "x"), (2, None), (3, "z")]),
    (T2, [(1, None), (2, None)]),
    (T3, [(1, "x"), (2, "y")]),
]
EXPECTED = [
    (1, None, T2, T3, False), (1, "x", T1, T2, False), (1, "x", T3, None, True),
    (2, None, T1, T3, False), (2, "y", T3, None, True), (3, "z", T1, None, True),
]


def by_text(data):
    return sorted(data, key=str)


def broken(history, key):
    """Overlapping or empty intervals, and current flags that do not match the interval."""
    order = Window.partitionBy(*key).orderBy(SCD_START)
    following = history.withColumn("next", F.lead(SCD_START).over(order))
    overlap = F.col("next").isNotNull() & (F.col(SCD_END).isNull() | (F.col(SCD_END) > F.col("next")))
    empty = F.coalesce(F.col(SCD_END) <= F.col(SCD_START), F.lit(False))
    return following.filter(overlap | empty | (F.col(SCD_CURRENT) != F.col(SCD_END).isNull())).count()


def fold(spark, path, batches, schema="k int, v string"):
    table = Scd2Table(spark, str(path))
    for number, (at, data) in enumerate(batches):
        table.apply(spark.createDataFrame(data, schema), ["k"], ["v"], number, at)
    return table


def test_fold_and_replay(spark, tmp_path):
    table = fold(spark, tmp_path / "h", BATCHES)
    assert by_text(rows(table.history())) == by_text(EXPECTED)
    assert rows(table.current()) == by_text([r for r in EXPECTED if r[4]])
    table.apply(spark.createDataFrame(BATCHES[2][1], "k int, v string"), ["k"], ["v"], 2, T3)
    assert by_text(rows(table.history())) == by_text(EXPECTED)
    # The state after an earlier batch stays readable.
    assert table.history(0).count() == 3 and table.history(1).count() == 4
    assert broken(table.history(), ["k"]) == 0


@pytest.mark.parametrize("broadcast", [False, True])
def test_both_joins_fold_alike(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(pairing, "prefer_broadcast", lambda stored, batch: broadcast)
    assert by_text(rows(fold(spark, tmp_path / "h", BATCHES).history())) == by_text(EXPECTED)


def all_rows(spark, batches):
    data = [(k, v, at) for at, batch in batches for k, v in batch]
    return spark.createDataFrame(data, "k int, v string, at timestamp")


@pytest.mark.parametrize("hot_rows", [10**9, 1])
def test_rebuild(spark, small_inputs_skew, hot_rows):
    history = rebuild_scd2(all_rows(spark, BATCHES), ["k"], ["v"], "at", hot_rows=hot_rows)
    assert by_text(rows(history)) == by_text(EXPECTED)


def brute_force(batches):
    open_rows, out = {}, []
    for at, batch in batches:
        for k, v in batch:
            if k in open_rows and open_rows[k][0] == v:
                continue
            if k in open_rows:
                old, since = open_rows[k]
                out.append((k, old, since, at, False))
            open_rows[k] = (v, at)
    return out + [(k, v, since, None, True) for k, (v, since) in open_rows.items()]


@pytest.mark.parametrize("seed", range(3))
def test_random_histories(spark, small_inputs_skew, seed):
    """One key has most of the rows; its history is cut into slices."""
    rng = random.Random(seed)
    batches = []
    for i in range(150):
        keys = {0, *[rng.randrange(1, 30) for _ in range(3)]}
        batches.append((T1 + timedelta(hours=i * rng.choice([1, 1, 1])), [
            (k, rng.choice([None, "a", "b"])) for k in sorted(keys)]))
    expected = by_text(brute_force(batches))
    frame = all_rows(spark, batches).repartition(3)
    assert by_text(rows(rebuild_scd2(frame, ["k"], ["v"], "at"))) == expected
    sliced = rebuild_scd2(frame, ["k"], ["v"], "at", hot_rows=20)
    assert by_text(rows(sliced)) == expected and broken(sliced, ["k"]) == 0


def test_stale_batch_is_refused(spark, tmp_path):
    table = fold(spark, tmp_path / "h", BATCHES)
    same = spark.createDataFrame([(1, "x")], "k int, v string")
    other = spark.createDataFrame([(1, "q")], "k int, v string")
    assert apply_scd2(table.current(), same, ["k"], ["v"], T1).count() == 3
    with pytest.raises(PySparkException, match="StaleBatch"):
        apply_scd2(table.current(), other, ["k"], ["v"], T3).collect()


def test_deletes_close_versions(spark, tmp_path):
    table = fold(spark, tmp_path / "h", BATCHES[:1])
    batch = spark.createDataFrame([(1, "x")], "k int, v string")
    gone = spark.createDataFrame([(1,), (3,), (8,)], "k int")
    table.apply(batch, ["k"], ["v"], 1, T2, deletes=gone)
    # Key 1 is in the batch, so it lives on.
    assert rows(table.current().select("k")) == [(1,), (2,)]
    assert rows(table.history().filter(~F.col(SCD_CURRENT)).select("k", SCD_END)) == [(3, T2)]


def test_new_columns(spark, tmp_path):
    table = Scd2Table(spark, str(tmp_path / "h"))
    table.apply(spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), ["k"], ["v"], 0, T1)
    wider = spark.createDataFrame([(1, "x", "n1"), (2, "Y", "n2")], "k int, v string, note string")
    table.apply(wider, ["k"], ["v"], 1, T2)
    # Outside the change list a new column opens no version, and is not stored for unchanged keys either.
    assert by_text(rows(table.history().select("k", "v", "note", SCD_CURRENT))) == by_text([
        (1, "x", None, True), (2, "y", None, False), (2, "Y", "n2", True)])
    table.apply(wider, ["k"], ["v"], 2, T3, overwrite=["note"])
    assert rows(table.current().select("k", "note")) == [(1, "n1"), (2, "n2")]
    table.apply(wider, ["k"], ["v", "note"], 3, datetime(2024, 4, 1))
    assert table.history().count() == 3


def test_actions(spark):
    history = rebuild_scd2(all_rows(spark, BATCHES), ["k"], ["v"], "at")
    batch = spark.createDataFrame([(1, "x"), (2, "n"), (4, "f"), (4, "g"), (None, "h")], "k int, v string")
    actions = paired_actions(history.filter(SCD_CURRENT), batch, ["k"], ["v"])
    assert rows(actions.select("k", "action")) == [(1, "unchanged"), (2, "change"), (3, "keep"), (4, "insert")]


def test_empty_table(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, v string").schema
    table = Scd2Table(spark, str(tmp_path / "none"), schema)
    assert not table.exists() and table.current().count() == 0 and table.history().columns[-1] == SCD_CURRENT
    with pytest.raises(FileNotFoundError):
        Scd2Table(spark, str(tmp_path / "none")).history()


# --- late rows --------------------------------------------------------------------------------------------

def spliced(spark, path, arrivals, seen=True, **options):
    """Batches (time, rows) taken in as they arrive; ``seen``: with all rows that came before."""
    table, past = Scd2Table(spark, str(path)), []
    for number, (at, data) in enumerate(arrivals):
        past.append((at, data))
        table.splice(all_rows(spark, [(at, data)]), ["k"], ["v"], number, ts="at",
                     observed=all_rows(spark, past) if seen else None, **options)
    return table


@pytest.mark.parametrize("seed", range(4))
def test_any_order_of_arrival_gives_the_rebuilt_history(spark, tmp_path, seed):
    rng = random.Random(seed)
    batches = [(T1 + timedelta(days=i), [(k, rng.choice([None, "a", "b"])) for k in range(6) if rng.random() < 0.7])
               for i in range(8)]
    arrivals = rng.sample(batches, len(batches))
    table = spliced(spark, tmp_path / "h", arrivals)
    expected = by_text(brute_force(batches))
    assert by_text(rows(table.history())) == expected and broken(table.history(), ["k"]) == 0
    assert rows(table.current()) == by_text([r for r in expected if r[4]])
    # Earlier states stay readable, and compaction changes nothing.
    for number in (3, 6):
        assert by_text(rows(table.history(number))) == by_text(brute_force(sorted(arrivals[:number + 1])))
    table.expire(2)
    assert by_text(rows(table.history())) == expected
    late = (T1 + timedelta(hours=36), [(0, "c"), (9, "c")])
    table.splice(all_rows(spark, [late]), ["k"], ["v"], 8, ts="at", observed=all_rows(spark, batches))
    assert by_text(rows(table.history())) == by_text(brute_force(sorted([*batches, late])))


def test_one_batch_may_hold_many_times(spark, tmp_path):
    table = Scd2Table(spark, str(tmp_path / "h"))
    table.splice(all_rows(spark, [BATCHES[0], BATCHES[2]]), ["k"], ["v"], 0, ts="at")
    table.splice(all_rows(spark, [BATCHES[1]]), ["k"], ["v"], 1, ts="at", observed=all_rows(spark, BATCHES))
    assert by_text(rows(table.history())) == by_text(EXPECTED)
    # The same batch again, and one without rows, change nothing.
    table.splice(all_rows(spark, [BATCHES[1]]), ["k"], ["v"], 1, ts="at", observed=all_rows(spark, BATCHES))
    table.splice(all_rows(spark, []), ["k"], ["v"], 2, ts="at")
    assert by_text(rows(table.history())) == by_text(EXPECTED)


def test_unchanged_rows_after_a_late_one_open_versions(spark, tmp_path):
    arrivals = [(T1, [(1, "a")]), (T3, [(1, "a")]), (T2, [(1, "b")])]
    history = spliced(spark, tmp_path / "h", arrivals).history()
    assert by_text(rows(history)) == by_text([(1, "a", T1, T2, False), (1, "b", T2, T3, False), (1, "a", T3, None, True)])
    blind = spliced(spark, tmp_path / "b", arrivals, seen=False).history()
    assert by_text(rows(blind)) == by_text([(1, "a", T1, T2, False), (1, "b", T2, None, True)])


def test_late_rows_keep_deletions(spark, tmp_path):
    T4 = datetime(2024, 4, 1)
    table = fold(spark, tmp_path / "h", [(T1, [(1, "a"), (2, "a")])])
    table.apply(spark.createDataFrame([(2, "a")], "k int, v string"), ["k"], ["v"], 1, T3,
                deletes=spark.createDataFrame([(1,)], "k int"))
    past = [(T1, [(1, "a"), (2, "a")]), (T3, [(2, "a")])]
    table.splice(all_rows(spark, [(T2, [(1, "b")])]), ["k"], ["v"], 2, ts="at", observed=all_rows(spark, past))
    assert by_text(rows(table.history().filter("k = 1"))) == by_text([(1, "a", T1, T2, False), (1, "b", T2, T3, False)])
    # After the deletion the same value is a version of its own.
    table.splice(all_rows(spark, [(T4, [(1, "b")])]), ["k"], ["v"], 3, ts="at", observed=all_rows(spark, past))
    assert by_text(rows(table.history().filter("k = 1"))) == by_text(
        [(1, "a", T1, T2, False), (1, "b", T2, T3, False), (1, "b", T4, None, True)])


def test_only_affected_keys_are_written_again(spark, tmp_path):
    batches = [(T1 + timedelta(days=i), [(k, str(i)) for k in range(50)]) for i in range(4)]
    table = spliced(spark, tmp_path / "h", batches)
    late = (T1 + timedelta(hours=60), [(7, "x")])
    table.splice(all_rows(spark, [late]), ["k"], ["v"], 4, ts="at", observed=all_rows(spark, batches))
    closed = spark.read.parquet(str(tmp_path / "h" / "v=4" / "scd_is_current=false"))
    assert sorted((r["k"], r["v"]) for r in closed.collect()) == [(7, "2"), (7, "x")]
    assert by_text(rows(table.history())) == by_text(brute_force(sorted([*batches, late])))


def test_late_rows_bring_new_columns(spark, tmp_path):
    table = spliced(spark, tmp_path / "h", [BATCHES[0], BATCHES[2]])
    wider = all_rows(spark, [BATCHES[1]]).withColumn("note", F.lit("n"))
    table.splice(wider, ["k"], ["v"], 2, ts="at", observed=all_rows(spark, BATCHES))
    assert by_text(rows(table.history().select("k", "v", "note", SCD_START))) == by_text([
        (1, "x", None, T1), (1, None, "n", T2), (1, "x", None, T3), (2, None, None, T1), (2, "y", None, T3), (3, "z", None, T1)])


@pytest.mark.parametrize("by_joins", [False, True])
@pytest.mark.parametrize("hot", [False, True])
def test_both_ways_of_splicing_give_the_rebuilt_history(spark, tmp_path, monkeypatch, small_inputs_skew, by_joins, hot):
    rng, copies = random.Random(9), []
    staged = tables.staged
    monkeypatch.setattr(tables, "staged", lambda df, *path: copies.append(df) or staged(df, *path))
    monkeypatch.setattr(tables, "prefer_broadcast", lambda *_: by_joins)
    spark.conf.set("stratamart.hotRows", "2" if hot else "1000")
    try:
        batches = [(T1 + timedelta(days=i), [(k, rng.choice([None, "a", "b"])) for k in range(6) if rng.random() < 0.7])
                   for i in range(6)]
        table = spliced(spark, tmp_path / "h", rng.sample(batches, len(batches)))
        assert by_text(rows(table.history())) == by_text(brute_force(batches))
    finally:
        spark.conf.unset("stratamart.hotRows")
    # In one shuffle nothing is copied but the batches.
    assert len(copies) == len(batches) if not by_joins and not hot else len(copies) > len(batches)


def test_a_splice_at_once_keeps_deletions_and_replaced_versions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "prefer_broadcast", lambda *_: False)
    table = fold(spark, tmp_path / "h", [(T1, [(1, "a"), (2, "a"), (3, "a")])])
    table.apply(spark.createDataFrame([(2, "a")], "k int, v string"), ["k"], ["v"], 1, T3, deletes=spark.createDataFrame([(1,)], "k int"))
    counts = LoadCounts()
    table.splice(all_rows(spark, [(T2, [(1, "b"), (2, "a"), (None, "x")])]), ["k"], ["v"], 2, ts="at", counts=counts)
    assert by_text(rows(table.history())) == by_text(
        [(1, "a", T1, T2, False), (1, "b", T2, T3, False), (2, "a", T1, None, True), (3, "a", T1, None, True)])
    assert (counts.values()["rows_read"], counts.values()["rows_rejected"], counts.values()["rows_revised"]) == (3, 1, 1)
    # A row at the time of the deletion wins over it.
    table.splice(all_rows(spark, [(T3, [(1, "b")])]), ["k"], ["v"], 3, ts="at")
    assert by_text(rows(table.history().filter("k = 1"))) == by_text([(1, "a", T1, T2, False), (1, "b", T2, None, True)])
