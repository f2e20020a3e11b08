import json
import time
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.functions.scalars import epoch_timestamp, utc_datetime, utc_literal
from stratamart.operators.conform import stamp
from stratamart.plans.ingestion import (
    INFO_B_SOURCE, SALES, STATUS_B_SOURCE, clean_info_b, clean_status_b, info_a_source, info_b_source, status_a_source,
    status_b_source,
)
from stratamart.sources.feeds import malformed_documents, page_of, paged_records
from stratamart.sources.generators import contacts_batch, sales_batch
from stratamart.spec import INGEST_TS, schema_of

RECORD = T.StructType().add("id", "integer").add("name", "string")


def land(folder, documents):
    folder.mkdir(exist_ok=True)
    for i, document in enumerate(documents):
        text = document if isinstance(document, str) else json.dumps(document)
        (folder / f"page{i}.json").write_text(text)
    return str(folder)


PAGES = [
    {"results": [{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]},
    {"results": [{"id": 3, "name": "c"}, {"id": 4, "name": None}]},
    {"results": []},
    {"other": 1},
]


def test_pages(spark, tmp_path):
    path = land(tmp_path / "p", PAGES)
    assert rows(paged_records(spark, path, RECORD)) == [(1, "a"), (2, "b"), (3, "c"), (4, None)]
    picked = paged_records(spark, path, RECORD, where="id > 1", select=["id * 10 as n"], order_by=["n desc"])
    assert [r[0] for r in picked.collect()] == [40, 30, 20]


def test_pages_over_several_lines(spark, tmp_path):
    path = land(tmp_path / "p", [json.dumps(p, indent=2) for p in PAGES])
    assert paged_records(spark, path, RECORD, multi_line=True).count() == 4


def test_missing_folder_is_an_empty_source(spark, tmp_path):
    none = str(tmp_path / "none")
    assert paged_records(spark, none, RECORD, where="id > 1").count() == 0
    assert info_a_source(spark, none).count() == 0
    feed = info_b_source(spark, none)
    assert feed.count() == 0 and feed.schema.names == INFO_B_SOURCE.names


def test_malformed_pages_are_quarantined(spark, tmp_path):
    path = land(tmp_path / "p", [*PAGES, '{"results": [{"id": 9'])
    assert paged_records(spark, path, RECORD).count() == 4
    broken = malformed_documents(spark, path, RECORD).collect()
    assert [r["document"] for r in broken] == ['{"results": [{"id": 9'] and broken[0]["file"].endswith("page4.json")


def test_page_of(spark):
    df = spark.range(50)
    assert [r[0] for r in page_of(df, [F.desc("id")], 10, 3).collect()] == [39, 38, 37]


def test_status_pages_are_stamped(spark, tmp_path):
    at = datetime(2024, 5, 1)
    record = {"stationcode": "7", "numbikesavailable": 3, "is_installed": "OUI",
              "coordonnees_geo": {"lon": 2.5, "lat": 48.5}}
    path = land(tmp_path / "p", [{"results": [record, {"stationcode": None}]}])
    found = status_a_source(spark, path, at).collect()
    assert len(found) == 1 and found[0]["timestamp"] == at and found[0]["coordonnees_geo"]["lon"] == 2.5


def test_info_feed(spark, tmp_path):
    stations = [
        {"station_id": "12", "name": "n", "lat": "45.5", "lon": 4.5, "address": "s", "rental_methods": ["card", "key"],
         "capacity": "20"},
        {"station_id": 13, "name": "m", "lat": 45.5, "lon": 4.5, "address": "s", "capacity": "many"},
        {"station_id": None, "name": "lost"},
    ]
    path = land(tmp_path / "f", [{"last_updated": 1_700_000_000, "data": {"stations": stations}}])
    found = rows(info_b_source(spark, path))
    assert found == [(12, "n", 45.5, 4.5, "s", "card,key", 20, 1_700_000_000),
                     (13, "m", 45.5, 4.5, "s", "", None, 1_700_000_000)]
    assert clean_info_b(info_b_source(spark, path)).first()["last_updated"] == datetime(2023, 11, 14, 22, 13, 20)


def test_status_feed(spark, tmp_path):
    def station(i, reported):
        return {"station_id": str(i), "num_bikes_available": 1, "num_bikes_disabled": 2, "num_docks_available": "3",
                "num_docks_disabled": 4, "is_installed": 1, "is_renting": 0, "is_returning": None,
                "last_reported": reported}
    document = {"last_updated": "1700000000", "data": {"stations": [station(1, 1_699_999_999), station(2, -3 * 10**9)]}}
    raw = status_b_source(spark, land(tmp_path / "f", [document]))
    assert raw.schema.names == STATUS_B_SOURCE.names and raw.count() == 2
    clean = clean_status_b(raw).collect()
    assert len(clean) == 1
    assert (clean[0]["is_installed"], clean[0]["is_renting"], clean[0]["is_returning"]) == (True, False, None)


def test_generated_sales_do_not_depend_on_partitions(spark):
    at = datetime(2024, 5, 1)
    once = sales_batch(spark, 500, 2, at, seed=3)
    again = sales_batch(spark, 500, 2, at, seed=3).repartition(7)
    assert rows(once) == rows(again)
    assert rows(once) != rows(sales_batch(spark, 500, 2, at, seed=4))
    assert [f.name for f in once.schema.fields] == SALES.names
    assert [f.dataType for f in once.schema.fields] == [f.dataType for f in SALES.fields]


def test_generated_sales_are_in_their_domains(spark):
    df = sales_batch(spark, 5000, 2, datetime(2024, 5, 1))
    low, high, cheap, dear, free, first, last, promos = df.agg(
        F.min("quantity"), F.max("quantity"), F.min("unit_price"), F.max("unit_price"),
        F.avg(F.col("promo_code").isNull().cast("int")), F.min("order_date"), F.max("order_date"),
        F.count_distinct("promo_code")).first()
    assert (low, high, promos) == (1, 5, 3) and cheap >= Decimal("100") and dear <= Decimal("1000.01")
    assert 0.2 < free < 0.3 and date(2024, 2, 1) <= first and last == date(2024, 5, 1)
    assert df.select("customer_id").distinct().count() == 10 and df.select("product_id").distinct().count() == 5


def test_generated_contacts(spark):
    found = contacts_batch(spark, 120, datetime(2024, 5, 1)).orderBy(F.col("contact_id").cast("int")).collect()
    assert found[0]["phone"] == "+1-555-0101" and found[9]["zip_code"] == "10010"
    assert found[119]["phone"] == "+1-555-01120" and found[4]["city"] == "Chicago"
    assert found[1]["job_title"] == "Sales Rep" and found[2]["customer_id"] == "CUST3"


def test_globs_lists_and_missing_paths(spark, tmp_path):
    record = T.StructType.fromDDL("id int, at struct<lon:double,lat:double>")
    for day, text in (("2024-01", '{"results": [{"id": "7", "at": {"lon": "1.5", "lat": 2}}, {"id": 8}]}'), ("2024-02", '{"results": [{"id": "x"}]}'), ("2023-01", "{broken")):
        (tmp_path / day).mkdir()
        (tmp_path / day / "page.json").write_text(text + "\n")
    found = paged_records(spark, f"{tmp_path}/2024-*", record).select("id", "at.lon", "at.lat").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(7, 1.5, 2.0), (8, None, None), (None, None, None)], key=str)
    both = [f"{tmp_path}/2024-01", f"{tmp_path}/none-*", f"{tmp_path}/2024-02/page.json"]
    assert paged_records(spark, both, record).count() == 3
    assert paged_records(spark, f"{tmp_path}/none", record).count() == 0
    assert malformed_documents(spark, f"{tmp_path}/*", record).count() == 1
    assert malformed_documents(spark, f"{tmp_path}/none", record).count() == 0


def test_impossible_epochs_are_null(spark):
    df = spark.createDataFrame([(0,), (10**18,), (-(10**18),), (None,)], "s long").select(F.unix_seconds(epoch_timestamp(F.col("s"))).alias("s"))
    assert [r["s"] for r in df.collect()] == [0, None, None, None]


def test_literals_do_not_depend_on_the_machine(spark, monkeypatch):
    at = datetime(2024, 3, 10, 2, 30)
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        zoned = at.replace(tzinfo=timezone(timedelta(hours=-5)))
        got = spark.range(1).select(F.unix_micros(utc_literal(at)), F.unix_micros(utc_literal(zoned))).first()
        assert utc_datetime(got[0]) == at and utc_datetime(got[1]) == at + timedelta(hours=5)
        stamped = stamp(spark.range(1), at).select(F.date_format(INGEST_TS, "yyyy-MM-dd HH:mm")).first()[0]
        assert stamped == "2024-03-10 02:30"
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()


@pytest.mark.parametrize("offset,limit", [(0, 5), (37, 10), (95, 20), (200, 5), (99, 1), (40, 0)])
def test_deep_pages_equal_shallow_ones(spark, offset, limit):
    df = spark.range(100).select(F.when(F.col("id") % 9 != 0, F.col("id") % 7).alias("a"), "id").repartition(6)
    order = [F.desc("a"), "id"]
    assert page_of(df, order, offset, limit, deep=-1).collect() == page_of(df, order, offset, limit).collect()
