from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from stratamart.operators.quality import check_table, duplicate_keys, null_counts, orphan_count, orphan_counts, orphans
from stratamart.plans.runs import log_findings
from stratamart.spec import ForeignKey, SaveMode, TableSpec, schema_of

AT = datetime(2024, 1, 1)
SPEC = TableSpec(
    "fact", "gold", schema_of({"id": "integer", "d": "string", "e": "string", "n": "integer"}, required=("id", "n")),
    SaveMode.MERGE, ("id",),
    foreign_keys=(ForeignKey(("d",), "dim_d", ("d_key",)), ForeignKey(("e",), "dim_e", ("e",))),
)


def planted(spark):
    data = [(i, f"d{i % 5}", f"e{i % 4}", i) for i in range(20)]
    data += [(3, "d0", "e0", 1), (4, "d0", "e0", 1)]            # two doubled keys
    data += [(100, "x", "e0", 1), (101, "y", "e0", 1), (102, "x", "f", 1), (103, None, "f", 1), (104, "x", "f", 1)]
    data += [(105, "d0", "e0", None)]
    return spark.createDataFrame(data, "id int, d string, e string, n int")


def dims(spark):
    return {"dim_d": spark.createDataFrame([(f"d{i}",) for i in range(5)], "d_key string"),
            "dim_e": spark.createDataFrame([(f"e{i}",) for i in range(4)], "e string")}


def test_planted_defects(spark):
    found = {(r["check_name"], r["columns"]): r["violations"] for r in check_table(
        SPEC, planted(spark), dims(spark), AT).collect()}
    assert found == {
        ("primary_key", "id"): 2, ("not_null", "id"): 0, ("not_null", "n"): 1,
        ("foreign_key:dim_d", "d"): 4, ("foreign_key:dim_e", "e"): 3,
    }


def test_offending_rows(spark):
    fact, d = planted(spark), dims(spark)["dim_d"]
    assert rows(duplicate_keys(fact, ["id"])) == [(3, 2), (4, 2)]
    assert rows(orphans(fact, d, ["d"], ["d_key"]).select("id")) == [(100,), (101,), (102,), (104,)]
    assert rows(orphan_count(fact, d, ["d"], ["d_key"])) == [(4,)]
    assert rows(orphan_count(fact, fact.select("d"), ["d"], ["d"])) == [(0,)]
    assert rows(null_counts(fact, ["d", "n"])) == [("d", 1), ("n", 1)]


def test_all_references_are_counted_at_once(spark):
    fact, d = planted(spark), dims(spark)
    both = fact.withColumn("two", F.col("n") % 3)
    pairs = spark.createDataFrame([(0, "d0"), (1, "d1")], "m long, q string")
    counts = orphan_counts(both, [("d", ["d"], d["dim_d"], ["d_key"]), ("e", ["e"], d["dim_e"], ["e"]),
                                  ("pair", ["two", "d"], pairs, ["m", "q"]), ("all", ["e"], fact, ["e"])])
    expected = both.where("two is not null and d is not null and not (two = 0 and d = 'd0' or two = 1 and d = 'd1')").count()
    assert rows(counts) == [("all", 0), ("d", 4), ("e", 3), ("pair", expected)]


def test_versions_share_their_key(spark):
    spec = TableSpec("dim", "gold", schema_of({"k": "integer"}), SaveMode.MERGE_SCD2, ("k",))
    df = spark.createDataFrame([(1, True), (1, False), (2, True), (2, True)], "k int, scd_is_current boolean")
    found = check_table(spec, df, {}, AT).filter(F.col("check_name") == "primary_key").first()
    assert found["violations"] == 1


def test_findings_of_all_runs_are_kept(spark, tmp_path):
    path, later = str(tmp_path / "findings"), AT + timedelta(days=1)
    for at in (AT, later, later):
        log_findings(check_table(SPEC, planted(spark), dims(spark), at), path)
    kept = spark.read.parquet(path).filter(F.col("check_name") == "primary_key")
    assert [r["violations"] for r in kept.orderBy("ingest_ts").collect()] == [2, 2]


def test_keys_are_packed_and_checks_leave_no_shuffle_to_run(spark):
    digits = "0123456789abcdef" * 4
    data = [(digits, "x"), (digits, "y"), (digits.upper(), "x"), ("41", "A"), ("A", "A"), (None, "x"), (None, "x"), ("", None)]
    df = spark.createDataFrame(data, "k string, d string")
    spec = TableSpec("t", "gold", schema_of({"k": "string", "d": "string"}), SaveMode.MERGE, ("k",),
                     foreign_keys=(ForeignKey(("k",), "dim", ("k",)), ForeignKey(("d",), "dim_d", ("d",))))
    dim, dim_d = spark.createDataFrame([(digits,), ("A",), ("",)], "k string"), spark.createDataFrame([("x",)], "d string")
    found = check_table(spec, df, {"dim": dim, "dim_d": dim_d}, AT)
    assert {(r["check_name"], r["columns"]): r["violations"] for r in found.collect()} == {
        ("primary_key", "k"): 2, ("not_null", "k"): 2, ("foreign_key:dim", "k"): 2, ("foreign_key:dim_d", "d"): 3}
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    counts = orphan_counts(df, [("dim", ["k"], dim, ["k"])])
    assert "unhex" in counts._jdf.queryExecution().optimizedPlan().toString()
