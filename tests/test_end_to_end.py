"""Both subject areas from landed sources to checked star schemas, in two runs each."""

import json
from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from stratamart.operators.latest import next_sequence, stored_watermarks
from stratamart.operators.quality import check_table
from stratamart.plans import dimensions as dims
from stratamart.plans import facts, ingestion
from stratamart.plans.runs import read_table, run_model, run_pipeline
from stratamart.sources.generators import contacts_batch, sales_batch
from stratamart.spec import INGEST_TS, SOURCE_INGEST_TS

T1, T2 = datetime(2024, 3, 1), datetime(2024, 4, 1)


def violations(spec, df, references):
    found = check_table(spec, df, references, T2).filter("violations > 0")
    return [(r["check_name"], r["columns"], r["violations"]) for r in found.collect()]


def test_sales_area(spark, tmp_path):
    root = str(tmp_path)
    for number, at in enumerate((T1, T2)):
        line = next_sequence(read_table(spark, ingestion.CLEAN_SALES, root), "order_line").first()[0]
        assert line == number + 1
        run_pipeline(spark, ingestion.sales_pipeline(lambda s, n=line, t=at: sales_batch(s, 60, n, t, seed=n)),
                     root, number, at)
        run_pipeline(spark, ingestion.contacts_pipeline(lambda s, t=at: contacts_batch(s, 10, t)), root, number, at)
        sales = read_table(spark, ingestion.CLEAN_SALES, root)
        contacts = read_table(spark, ingestion.CLEAN_CONTACTS, root)
        for name in ("dim_product", "dim_store", "dim_promo"):
            run_model(spark, dims.dimension_model(name), root, number, at, sales=sales)
        run_model(spark, dims.CUSTOMER_MODEL, root, number, at, sales=sales, contacts=contacts, unique=True)
        run_model(spark, facts.SALES_MODEL, root, number, at, sales=sales)
    run_model(spark, dims.DATE_MODEL, root, 0, T1, spark=spark, start=T1.date().replace(year=2023), end=T2.date())

    fact = read_table(spark, facts.FACT_SALES, root)
    assert fact.count() == 120 and fact.columns == facts.FACT_SALES.columns
    tables = {s.name: read_table(spark, s, root) for s in (
        dims.DIM_CUSTOMER, dims.DIM_PRODUCT, dims.DIM_STORE, dims.DIM_PROMO, dims.DIM_DATE)}
    assert violations(facts.FACT_SALES, fact, tables) == []
    for spec in (dims.DIM_CUSTOMER, dims.DIM_PRODUCT, dims.DIM_STORE, dims.DIM_PROMO):
        assert violations(spec, tables[spec.name], {}) == []

    # The second batch renames two brands, one store and every customer that bought again.
    brands = rows(tables["dim_product"].filter("product_id = 'PROD1'").select("brand", "scd_is_current"))
    assert brands == [("BrandA 1", False), ("BrandA 2", True)]
    assert tables["dim_product"].filter("product_id = 'PROD5'").count() == 1
    customer = tables["dim_customer"].filter("customer_id = 'CUST3' and scd_is_current").first()
    assert customer["customer_name"] == "Customer 3 2" and customer["email"] == "contact2@example.com"
    assert tables["dim_promo"].filter("promo_key = '-1'").count() == 1


def land(folder, name, document):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(document))
    return str(folder)


def a_station(code, bikes, capacity):
    return {"stationcode": code, "name": f"Gare {code}", "capacity": capacity, "is_installed": "OUI",
            "numdocksavailable": capacity - bikes, "numbikesavailable": bikes, "mechanical": bikes, "ebike": 0,
            "is_renting": "NON", "is_returning": None, "duedate": "2024-03-01T10:00:00",
            "coordonnees_geo": {"lon": 2.25, "lat": 48.5}, "station_opening_hours": "24h"}


def b_feed(at, stations):
    return {"last_updated": int((at - datetime(1970, 1, 1)).total_seconds()), "data": {"stations": stations}}


def b_info(i, capacity):
    return {"station_id": str(i), "name": f"Quai {i}", "lat": 45.5, "lon": 4.5, "address": f"RUE {i}",
            "rental_methods": ["KEY"], "capacity": capacity}


def b_status(i, bikes, at):
    seconds = int((at - datetime(1970, 1, 1)).total_seconds())
    return {"station_id": str(i), "num_bikes_available": bikes, "num_bikes_disabled": 0, "num_docks_available": 5,
            "num_docks_disabled": 0, "is_installed": 1, "is_renting": 1, "is_returning": 0, "last_reported": seconds}


def test_station_area(spark, tmp_path):
    root, landing = str(tmp_path / "lake"), tmp_path / "landing"
    sources = (dims.SOURCE_A, dims.SOURCE_B)
    for number, (at, capacity) in enumerate(((T1, 20), (T2, 25))):
        pages = land(landing / f"a{number}", "p1.json", {"results": [
            a_station("1", 3 + number, capacity), a_station("2", 4, 20), {"stationcode": None}]})
        info = land(landing / f"bi{number}", "f.json", b_feed(at, [b_info(7, capacity), b_info(8, 30)]))
        status = land(landing / f"bs{number}", "f.json", b_feed(at, [b_status(7, 1 + number, at), b_status(8, 2, at)]))
        for pipeline in (
            ingestion.info_a_pipeline(lambda s, p=pages: ingestion.info_a_source(s, p)),
            ingestion.status_a_pipeline(lambda s, p=pages, t=at: ingestion.status_a_source(s, p, t)),
            ingestion.info_b_pipeline(lambda s, p=info: ingestion.info_b_source(s, p)),
            ingestion.status_b_pipeline(lambda s, p=status: ingestion.status_b_source(s, p)),
        ):
            run_pipeline(spark, pipeline, root, number, at)
        run_model(spark, dims.STATION_MODEL, root, number, at,
                  info_a=read_table(spark, ingestion.CLEAN_INFO_A, root),
                  info_b=read_table(spark, ingestion.CLEAN_INFO_B, root))
        stored = read_table(spark, facts.FACT_BIKE_STATUS, root)
        loaded = stored_watermarks(stored, "station_source", SOURCE_INGEST_TS, sources)
        run_model(spark, facts.STATUS_MODEL, root, number, at, loaded=loaded,
                  status_a=read_table(spark, ingestion.CLEAN_STATUS_A, root),
                  status_b=read_table(spark, ingestion.CLEAN_STATUS_B, root))

    stations = read_table(spark, dims.DIM_BIKE_STATION, root)
    assert rows(stations.filter("station_id = '7'").select("capacity", "scd_is_current", "address")) == [
        (20, False, "rue 7"), (25, True, "rue 7")]
    assert stations.count() == 6 and stations.filter("scd_is_current").count() == 4
    fact = read_table(spark, facts.FACT_BIKE_STATUS, root)
    assert fact.count() == 8 and fact.groupBy(INGEST_TS).count().filter("count = 4").count() == 2
    first = fact.filter((F.col("station_id") == "1") & (F.col("date_key") == "20240301")).first()
    assert (first["is_installed"], first["is_renting"], first["is_returning"]) == (True, False, None)
    assert first["due_date"] == datetime(2024, 3, 1, 10) and first["available_docks"] == 17
    dates = dims.date_dimension(spark, T1.date(), T2.date(), T2)
    assert violations(facts.FACT_BIKE_STATUS, fact, {"dim_bike_station": stations, "dim_date": dates}) == []
