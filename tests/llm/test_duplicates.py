"""N-gram join, line deduplication and quality rules against brute force."""

import random

import pytest

import brute_force
from corpus_fixtures import documents  # noqa: F401
from stratamart.llm.components import component_roots
from stratamart.llm.line_dedup import dedup_lines
from stratamart.llm.ngram_join import ngram_components
from stratamart.llm.quality_rules import quality_filter, quality_rules

VOCABULARY = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        i = rng.randrange(len(w))
        w[i:i + 1] = rng.choice([[], [rng.choice(VOCABULARY)], [w[i], "new"]])
    return " ".join(w)


def corpus(seed=1):
    """Copies, chains of edits (links over several steps), a common passage, near copies around one text, odd rows."""
    rng = random.Random(seed)
    passage, rows = prose(rng, 30), []
    for _ in range(40):
        rows.append(prose(rng, rng.randint(1, 80)))
    for _ in range(30):
        rows.append(passage + " " + prose(rng, rng.randint(2, 30)))
    base = prose(rng, 120)
    rows += [edited(rng, base, rng.randint(0, 6)) for _ in range(60)]
    chain = prose(rng, 90)
    for _ in range(12):
        chain = edited(rng, chain, 2)
        rows.append(chain)
    rows += [rows[3]] * 25 + [rows[3].upper()] + [None, "", " \n\t", "one", "one", "One two", "one two three", "a b c d e f", prose(rng, 6_000)]
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80), (2, 50)])
def test_components_equal_all_pairs(documents, k, num):
    rows = corpus(k)
    got = {r["doc_id"]: (r["n"], r["component"]) for r in ngram_components(documents(rows), k, num, 100).collect()}
    assert got == brute_force.components(rows, k, num, 100)


def test_components_of_odd_tables(documents):
    assert ngram_components(documents([])).count() == 0
    long = "the same words stand here twice and more often still"
    got = sorted(((r["doc_id"] or 0), r["component"]) for r in ngram_components(documents(
        [(5, long), (5, long), (None, long), (4, long), (7, None), (8, ""), (8, "")])).collect())
    assert got == [(0, None), (4, 4), (5, 4), (5, 4), (7, 7), (8, 8), (8, 8)]


def test_rows_of_one_key_are_one_document(documents):
    a, b = "one text of some words that stands here", "another text with quite other words in it now"
    rows = [(5, a), (5, b), (3, a), (4, b), (9, "something else that is linked with nothing at all")]
    got = {(r["doc_id"], r["component"]) for r in ngram_components(documents(rows)).collect()}
    assert got == {(5, 3), (3, 3), (4, 3), (9, 9)}
    # Without any posting that two nodes share, too.
    assert {(r["doc_id"], r["component"]) for r in ngram_components(documents([(5, a), (5, b)])).collect()} == {(5, 5)}


def test_component_roots(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)] + [(5, 5)]
    root = {}
    for a, b in links:
        ra, rb = ({k for k in root if root[k] == root.get(x, x)} | {x} for x in (a, b))
        for x in ra | rb:
            root[x] = min(root.get(y, y) for y in ra | rb)
    roots = component_roots(spark.createDataFrame(links, "u long, v long"))
    assert {r["u"]: r["v"] for r in roots.collect()} == {a: b for a, b in root.items() if a != b}
    assert component_roots(spark.createDataFrame([(1, 1)], "u long, v long")) is None


def line_corpus():
    rng = random.Random(2)
    base = ["a line that is long enough, number %d" % i for i in range(12)] + ["short"] * 3
    base += ["x" * 40, "x" * 41, "x" * 39, "ab" * 20, "ba" * 20, "  spaced   out line with words ", "é" * 25 + "ü", "é" * 26]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = rng.choice(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                p = rng.randrange(len(line) + 1)
                line = rng.choice([line[:p] + line[p + 1:], line[:p] + rng.choice("xyz") + line[p:], line[:p] + rng.choice("xyz") + line[p + 1:]])
            lines.append(line)
        rows.append((rng.randint(0, 10**6), "\n".join(lines)))
    return list(dict(rows).items()) + [(-1, None), (-2, ""), (-3, "\n\n"), (-4, "y" * 3_000), (-5, "y" * 2_999 + "z")]


def test_lines_equal_all_pairs(documents):
    rows = line_corpus()
    got = dedup_lines(documents(rows))
    assert got.columns == ["doc_id", "text", "source", "n", "n_lines", "n_removed"]
    found, expected = {r["doc_id"]: r for r in got.collect()}, brute_force.lines_kept(rows, 20)
    assert {i: r["text"] for i, r in found.items()} == expected
    for i, t in rows:
        assert found[i]["n"] == 7 and found[i]["n_lines"] == (0 if t is None else t.count("\n") + 1)
        assert (found[i]["n_removed"] > 0) == (t != expected[i])


def test_lines_of_odd_tables(documents):
    assert dedup_lines(documents([])).count() == 0
    line = "one line that several documents have"
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["text"]) for r in dedup_lines(documents(
        [(2, line), (2, line), (3, line), (None, line + "!")])).collect())
    assert got == [(-1, line + "!"), (2, ""), (2, ""), (3, "")]
    got = sorted((r["doc_id"], r["text"]) for r in dedup_lines(documents([(2, line), (2, line), (3, line)])).collect())
    assert got == [(2, line), (2, line), (3, "")]

def test_very_long_near_equal_lines(documents):
    # All variants of one line would take 6.4 GB.
    rng = random.Random(5)
    line = "".join(rng.choice("abcdefgh ij") for _ in range(80_000)) + "."
    rows = [(1, line), (2, line[:30_000] + "Z" + line[30_001:])]
    assert {r["doc_id"]: r["text"] for r in dedup_lines(documents(rows)).collect()} == {1: line, 2: ""}


def quality_corpus():
    rng = random.Random(4)
    common, page = "All rights reserved 20%d." , "menu of the site with quite a few words in a line"
    rows = [(i, f"{prose(rng, rng.randint(0, 30))}\n{common % (i % 10)}\n{prose(rng, 6)}", "a") for i in range(60)]
    rows += [(100 + i, f"{page}\n{page[::-1]}\nNo{i}", "a") for i in range(30)] + [(200 + i, f"{page}\n{prose(rng, 20)}", "b") for i in range(5)]
    rows += [(300 + i, "one text with copies of more than ten words in just one line", None) for i in range(40)]
    rows += [(400, None, None), (401, "", "a"), (402, "a b c d e f a b c d e # $ <x>\n\n \na b", "c"), (403, "w " * 4_000, "c"),
             (404, "x y 　 z w " * 5, "c")]
    return rows


def test_quality_equals_brute_force(documents):
    rows = quality_corpus()
    expected = brute_force.quality(rows)
    got = quality_rules(documents(rows))
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == {i: e[:-1] for i, e in expected.items()}
    assert any(e[5] for e in expected.values()) and any(not e[6] and not e[7] for e in expected.values())
    kept = quality_filter(documents(rows))
    assert kept.columns == ["doc_id", "text", "source", "n"]
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {i: e[-1] for i, e in expected.items() if e[7]}


def test_quality_of_odd_tables(documents):
    assert quality_rules(documents([])).count() == 0
    text = "ten words or more have to stand in a text that is kept"
    got = quality_rules(documents([(1, text), (1, text), (None, text)])).collect()
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in got) == [(0, True), (1, True), (1, True)]
