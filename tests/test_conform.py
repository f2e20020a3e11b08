from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions import scalars
from stratamart.functions.keys import UNKNOWN_KEY, member_key, surrogate_key
from stratamart.operators.conform import (
    IncompatibleSchema, conform, decode_flags, drop_null_keys, error_list, evolve, flatten_struct, implausible, merged_schema, misfits,
    missing_keys, not_before, stamp,
)
from stratamart.spec import schema_of


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([("7", 1.5, "x")], "b string, a double, extra string")
    schema = schema_of({"a": "integer", "b": "long", "c": "string"})
    out = conform(df, schema)
    assert out.columns == ["a", "b", "c"] and rows(out) == [(1, 7, None)]
    assert conform(df, schema, keep_extra=True).columns == ["a", "b", "c", "extra"]


def test_conform_lenient(spark):
    df = spark.createDataFrame([("x",), ("12",)], "n string")
    schema = schema_of({"n": "integer"})
    assert rows(conform(df, schema, lenient=True)) == [(None,), (12,)]
    with pytest.raises(PySparkException):
        conform(df, schema).collect()


def test_stamp_is_the_given_time(spark):
    at = datetime(2024, 1, 2, 3, 4, 5)
    assert rows(stamp(spark.range(1), at)) == [(0, at)]


def test_flatten_struct_only_if_present(spark):
    df = spark.sql("select named_struct('lon', 2.5D, 'lat', 48D) as geo, 1 as id")
    assert rows(flatten_struct(df, "geo", {"lon": "longitude", "lat": "latitude"})) == [(1, 2.5, 48.0)]
    assert flatten_struct(df.drop("geo"), "geo", {"lon": "longitude"}).columns == ["id"]


def test_flags_keep_null(spark):
    df = spark.createDataFrame([("OUI", 1), ("NON", 0), (None, None)], "t string, n int")
    out = decode_flags(decode_flags(df, ["t", "absent"], "OUI"), ["n"], 1)
    assert rows(out) == [(None, None), (False, False), (True, True)]


def test_null_keys_and_bounds(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, v string")
    assert rows(drop_null_keys(df, ["k"])) == [(1, "a"), (2, None)]
    assert rows(drop_null_keys(df, ["k", "v"])) == [(1, "a")]
    seconds = spark.createDataFrame([(-3_000_000_000,), (0,), (None,)], "s long")
    kept = not_before(seconds.select(scalars.epoch_timestamp(F.col("s")).alias("t")), ["t"])
    assert rows(kept) == [(datetime(1970, 1, 1),)]


def test_evolution_adds_widens_and_refuses(spark):
    old = spark.createDataFrame([(1, 2, "x")], "k int, n int, gone string")
    new = spark.createDataFrame([(2, 3_000_000_000, "y")], "k int, n long, added string")
    a, b = evolve(old, new)
    assert rows(a.unionByName(b)) == [(1, 2, "x", None), (2, 3_000_000_000, None, "y")]
    # A narrower incoming type is read as the stored one.
    assert merged_schema(new.schema, old.schema)["n"].dataType == T.LongType()
    text = spark.createDataFrame([(1, "2")], "k int, n string")
    with pytest.raises(IncompatibleSchema):
        evolve(old, text)
    with pytest.raises(IncompatibleSchema):
        evolve(spark.sql("select cast(1 as decimal(10,2)) as d"), spark.sql("select cast(1 as decimal(10,4)) as d"))


def test_keys_are_injective(spark):
    parts = [None, "", "a", "b", "|", "\\", "\\N", "a|b", "a\\", "N", "\\|"]
    triples = [(x, y, z) for x in parts for y in parts for z in parts]
    df = spark.createDataFrame(triples, "a string, b string, c string")
    keys = df.select(surrogate_key(["a", "b", "c"]).alias("k"))
    assert keys.distinct().count() == len(triples) == 1331


def test_member_key_of_missing(spark):
    df = spark.createDataFrame([(None, None), (None, "b")], "a string, b string")
    keys = [r[0] for r in df.select(member_key(["a", "b"])).collect()]
    assert keys[0] == UNKNOWN_KEY and len(keys[1]) == 64


def test_scalars(spark):
    df = spark.createDataFrame(
        [("CUST12", "2024-01-01 00:00:00", Decimal("5.00"), Decimal("30.00"), 7), ("x", "nope", Decimal("5.00"),
         Decimal("0.00"), 12)], "id string, due string, part decimal(10,2), whole decimal(10,2), n int")
    out = df.select(
        scalars.trailing_digits(F.col("id")), scalars.parsed_timestamp(F.col("due")),
        scalars.percent_of(F.col("part"), F.col("whole")), scalars.zero_padded(F.col("n"), 4),
        scalars.cyclic_pick(["p", "q", "r"], F.col("n")), scalars.joined_text(F.lit(None).cast("array<string>")),
        scalars.decoded(F.col("n"), {7: "seven"}, "other"),
    )
    assert [tuple(r) for r in out.collect()] == [
        ("12", datetime(2024, 1, 1), Decimal("16.67"), "0007", "q", "", "seven"),
        ("", None, None, "0012", "p", "", "other"),
    ]


def test_weekend_is_a_parameter(spark):
    df = spark.sql("select explode(sequence(date'2024-01-05', date'2024-01-07')) as d")
    weekend = [r["is_weekend"] for r in df.select(*scalars.calendar_columns(F.col("d"))).collect()]
    assert weekend == [False, True, True]
    friday = [r["is_weekend"] for r in df.select(*scalars.calendar_columns(F.col("d"), (6, 7))).collect()]
    assert friday == [True, True, False]


def test_structs_evolve_field_by_field(spark):
    old = spark.sql("select 1 as id, named_struct('lon', 1D, 'lat', 2) as geo, array(named_struct('a', 1)) as items, map('x', named_struct('q', 1)) as m")
    new = spark.sql("select 2 as id, named_struct('lat', 3L, 'alt', 9D) as geo, array(named_struct('b', 'z', 'a', 2)) as items, map('y', named_struct('r', 2)) as m")
    schema = merged_schema(old.schema, new.schema)
    assert schema.simpleString() == ("struct<id:int,geo:struct<lon:double,lat:bigint,alt:double>,items:array<struct<a:int,b:string>>,"
                                     "m:map<string,struct<q:int,r:int>>>")
    first, second = evolve(old, new)
    both = first.unionByName(second).select("id", "geo.lon", "geo.lat", "geo.alt", F.col("items")[0]["a"].alias("a"), F.col("items")[0]["b"].alias("b"),
                                            F.col("m")["y"]["r"].alias("r"))
    assert rows(both) == [(1, 1.0, 2, None, 1, None, None), (2, None, 3, 9.0, 2, "z", 2)]
    assert rows(conform(spark.sql("select cast(null as struct<lon: double>) as geo"), new.select("geo").schema)) == [(None,)]
    with pytest.raises(IncompatibleSchema, match="geo.lat"):
        merged_schema(old.schema, spark.sql("select named_struct('lat', 'x') as geo").schema)


def test_undeclared_fields_stay_where_extra_columns_do(spark):
    df = spark.sql("select named_struct('lon', '1', 'lat', 'x', 'alt', 3) as geo")
    declared = T.StructType().add("geo", T.StructType().add("lon", "double").add("lat", "double"))
    assert conform(df, declared, lenient=True).collect()[0].geo.asDict() == {"lon": 1.0, "lat": None}
    assert conform(df, declared, lenient=True, keep_extra=True).collect()[0].geo.asDict() == {"lon": 1.0, "lat": None, "alt": 3}


def test_errors_of_a_row_are_listed(spark):
    df = spark.sql("select '7' as n, named_struct('lon', 'east') as geo, cast(null as string) as k, -3000000000L as t "
                   "union all select 'x', null, 'k', 5L")
    want = T.StructType().add("n", "integer").add("geo", T.StructType().add("lon", "double")).add("k", "string").add("t", "long")
    errors = error_list([*misfits(df.schema, want), *missing_keys(["k"]), *implausible(["t"], seconds=True)])
    found = [[tuple(e) for e in r[0]] for r in df.select(errors.alias("e")).collect()]
    assert found == [[("geo.lon", "east", "does not fit double", False), ("k", None, "missing key", True),
                      ("t", "-3000000000", "implausible time", False)], [("n", "x", "does not fit int", False)]]
    assert df.select(error_list([]).alias("e")).first()[0] == []
