"""Registered corpus queries against their SQL, and the pipeline's stages against brute force."""

import os
import re

import pytest

import __spark_entry__ as entry_points
import brute_force
import corpus_pipeline
from compare import compare, connect
from corpus_fixtures import SMALL, documents  # noqa: F401
from stratamart.llm.queries import ORACLES, QUERIES
from test_tokens import packed_right


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    verdict, _, _ = compare(spark, con, SMALL, name)
    assert verdict == "ok", verdict


def test_each_operator_has_one_query():
    names = [re.match(r"op(\d+)_", n)[1] for n in QUERIES]
    assert sorted(map(int, names)) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    table = {r["doc_id"]: r for r in docs.collect()}
    rows, columns = {i: r["text"] for i, r in table.items()}, docs.columns
    by_name = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "packing"]

    kept = brute_force.quality([(i, t, table[i]["source"]) for i, t in rows.items()])
    rows = {i: k[-1] for i, k in kept.items() if k[-2]}
    docs = stage(spark, by_name["quality_rules"], docs, columns, rows, table)

    left = brute_force.lines_kept(rows.items(), 20)
    rows = {i: t for i, t in left.items() if t == rows[i] or brute_force.words(t)}
    docs = stage(spark, by_name["line_dedup"], docs, columns, rows, table)

    found = brute_force.components(list(rows.items()), 5, 80, 100)
    rows = {i: t for i, t in rows.items() if found[i][1] == i}
    docs = stage(spark, by_name["ngram_jaccard_join"], docs, columns, rows, table)

    assert packed_right(by_name["packing"](spark, docs, SMALL).collect(), rows, 4096) > 0.95


def stage(spark, function, docs, columns, expected, table):
    got = function(spark, docs, SMALL)
    assert got.columns == columns
    found = {r["doc_id"]: r for r in got.collect()}
    assert {i: r["text"] for i, r in found.items()} == expected
    for i, r in found.items():
        assert (r["lang"], r["source"], r["n_chars"]) == (table[i]["lang"], table[i]["source"], len(r["text"]))
    return spark.createDataFrame([found[i] for i in sorted(found)], got.schema)


def test_stages_of_an_empty_table_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    line = "a line of more than ten words that stands in the text of some rows here"
    odd = spark.createDataFrame([(None, line, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, line, None, "s", 9)], docs.schema)
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, docs, SMALL).count() == 0, name
    kept = {name: sorted((r["doc_id"] or 0, r["text"]) for r in function(spark, odd, SMALL).collect())
            for name, function in corpus_pipeline.STAGES[:-1]}
    assert kept == {"quality_rules": [(0, line), (3, line)], "line_dedup": [(0, line), (1, None), (2, "")],
                    "ngram_jaccard_join": [(0, line), (1, None), (2, ""), (3, line)]}
    packed = [(r["doc_id"], r["doc_tokens"]) for r in dict(corpus_pipeline.STAGES)["packing"](spark, odd, SMALL).collect()]
    assert len(packed) == 4 and sorted(n for _, n in packed)[:2] == [1, 1]


def test_stages_keep_clashing_columns_and_release_their_tables(spark):
    line = "a line of more than ten words that stands in the text of some rows here"
    rows = [(1, line + "\n" + "x " * 30_000, "en", "s", 0, 7, 8, 9, 1), (2, line, "en", "s", 0, 7, 8, 9, 2), (2, line + " too", "en", "s", 0, 7, 8, 9, 3)]
    names = "doc_id long, text string, lang string, source string, n_chars long, n_lines int, n_removed int, stays int, component int"
    docs = spark.createDataFrame(rows, names)
    for name, function in corpus_pipeline.STAGES[:-1]:
        got = function(spark, docs, SMALL)
        assert got.columns == docs.columns, name
        assert {(r["n_lines"], r["n_removed"], r["stays"]) for r in got.collect()} == {(7, 8, 9)}, name
        staged = list(corpus_pipeline._staged)
        assert staged and all(os.path.exists(p.removeprefix("file:")) for p in staged), name
    corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in staged)
