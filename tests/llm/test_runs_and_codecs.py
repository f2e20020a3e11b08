"""Periodic runs, fill-in-the-middle and the byte-level codec against brute force and the library."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from brute_force import words
from corpus_fixtures import SMALL, documents  # noqa: F401
from stratamart.llm import byte_codec, fill_middle, periodic_runs
from stratamart.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = "a  b\t\n\n c\r\n  x's don't 12 ab1\x85\xa0 é🙂\x1c\x00 ²½中文…--- 　z   "


def plain_runs(found, least, periods):
    """Every stretch with a period, by definition."""
    n, out = len(found), {}
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and found[j] == found[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in out.items())


@pytest.mark.parametrize("least,periods", [(6, 4), (2, 2), (6, 3)])
def test_runs_equal_brute_force(least, periods):
    draw = random.Random(3)
    for _ in range(120):
        bundle = []
        for _ in range(draw.randint(0, 8)):
            n = draw.choice([0, 1, 5, 20, 60, 150])
            text = draw.choices("abcdefgh"[:draw.choice([1, 2, 3, 5])], k=n)
            if n and draw.random() < 0.4:
                p = draw.randint(1, min(9, n))
                text = [text[i % p] for i in range(n)]
            bundle.append(text)
        got = periodic_runs.runs_of(bundle, least, periods)
        assert [got.get(i, []) for i in range(len(bundle))] == [plain_runs(t, least, periods) for t in bundle]


def test_long_runs_take_little_time():
    block = [str(i * 7919 % 1009) for i in range(150)]
    assert periodic_runs.runs_of([["a"] * 200_000, block * 1000], 6, 4) == {0: [(0, 200_000, 1)], 1: [(0, 150_000, 150)]}


def test_runs_of_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "x " * 9 + "y"), (4, "a b " * 4), (4, "a b " * 4), (5, "a b c a b c a b c")]
    found = periodic_runs.periodic_runs(documents(rows)).collect()
    assert sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found) == [
        (0, [(0, 9, 1)], "x y"), (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 8, 2)], "a b"), (4, [(0, 8, 2)], "a b"),
        (5, [], "a b c a b c a b c")]
    assert periodic_runs.periodic_runs(documents(rows).limit(0)).count() == 0


def test_bundles_do_not_change_runs(documents, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BUNDLE_WORDS", 3)
    rows = [(i, "p q r s " * i) for i in range(9)]
    found = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic_runs.periodic_runs(documents(rows)).collect()}
    assert found == {i: plain_runs(words("p q r s " * i), 6, 4) for i in range(9)}


def test_cuts_at_every_unit():
    draw = random.Random(5)
    for _ in range(400):
        text = "".join(draw.choices("ab\n\né🙂", k=draw.randint(1, 40)))
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        blocks = fill_middle.TextBlocks(text.encode(), draw.choice([1, 2, 3, 5, 8, 64]))
        assert blocks.n_units == len(units)
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert blocks.after(k) == (len(before.encode()), len(before))


def test_fill_middle_of_odd_rows(documents):
    long = "é line\n" * 60_000
    rows = [(1, None), (2, ""), (3, "a <S> b\nc"), (None, "x\ny"), (4, "one\ntwo\nthree"), (4, "one\ntwo\nthree"), (5, long), (6, "\n")]
    made = fill_middle.fill_middle(documents(rows), seed=7)
    made = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((r["doc_id"] or 0, r["back"]) for r in made) == sorted((i or 0, t or "") for i, t in rows)
    by_id = {r["doc_id"]: r for r in made}
    for i in (1, 2, 3):
        assert (by_id[i]["form"], by_id[i]["prefix_chars"], by_id[i]["output"]) == ("plain", None, dict(rows)[i] or "")
    h = hashlib.sha256(b"7:5").hexdigest()
    a, b = sorted(int(h[i:i + 8], 16) % 60_001 for i in (0, 8))
    assert (by_id[5]["n"], by_id[5]["prefix_chars"], by_id[5]["middle_chars"]) == (60_000, 7 * a, 7 * (b - a))
    assert fill_middle.fill_middle(documents(rows).limit(0), seed=7).count() == 0
    assert {r["form"] for r in fill_middle.fill_middle(documents(rows), seed=7, percent=0).collect()} == {"plain"}


def test_fill_middle_forms():
    parts = {}
    for i in range(200):
        n, form, a, b, out = fill_middle._moved(i, b"1\n2\n3\n4", 7, 100, 50)
        parts[form] = parts.get(form, 0) + 1
        assert n == 4 and out.startswith(b"<P>" if form == "psm" else b"<S>") and b"<M>" in out
    assert 60 < parts["psm"] < 140 and parts["psm"] + parts["spm"] == 200


def test_numbers_go_back_and_forth():
    for numbers in ([], [0], [5, 255, 256, 70_000, (1 << 32) - 1, 0]):
        assert byte_codec.unpacked(byte_codec.packed(np.array(numbers, np.int64))).tolist() == numbers


def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_codec.ranks(RANKS).of, special_tokens={})


def test_words_are_cut_and_merged_as_by_the_library():
    import regex
    draw, lib = random.Random(7), library()
    for _ in range(1500):
        text = "".join(draw.choices(ODD + "abcdefgh'sdtre", k=draw.randint(0, 60)))
        spans = byte_codec.SPANS.findall(text)
        found = [w for s in spans for w in regex.findall(byte_codec.WORD_PATTERN, s)]
        assert [i for w in found for i in byte_codec.ranks(RANKS).encode(w.encode())] == lib.encode_ordinary(text)
    word = "ab" * 50_000
    assert byte_codec.ranks(RANKS).encode(word.encode()) == lib.encode_ordinary(word)


@pytest.mark.parametrize("limits", [(1, 1, 1), (40, 2, 5), (10**9, 3, 10**9), byte_codec.Limits()])
def test_codec_of_odd_rows(documents, limits):
    limits = byte_codec.Limits(*limits)
    rows = [(1, None), (2, ""), (None, ODD), (3, "<|endoftext|> x"), (4, "the the the"), (4, "the the the"), (5, "word " * 30_000), (6, "")]
    encoded = byte_codec.encode_documents(documents(rows), RANKS, limits=limits)
    lib = library()
    found = sorted((r["doc_id"] or 0, list(r["ids"])) for r in encoded.collect())
    assert found == sorted((i or 0, lib.encode_ordinary(t or "")) for i, t in rows)
    decoded = byte_codec.decode_documents(encoded.withColumn("bytes", F.lit(1)), RANKS)
    assert decoded.columns == ["doc_id", "bytes", "decoded"]
    assert sorted((r["doc_id"] or 0, bytes(r["decoded"]).decode()) for r in decoded.collect()) == sorted((i or 0, t or "") for i, t in rows)
    assert byte_codec.encode_documents(documents(rows).limit(0), RANKS).count() == 0


def test_decoding_fails_on_unknown_identifiers(spark):
    ids = spark.createDataFrame([(1, [15496, 995]), (2, None), (3, [])], "k int, ids array<int>")
    assert [bytes(r["decoded"]) for r in byte_codec.decode_documents(ids, RANKS).orderBy("k").collect()] == [b"Hello world", b"", b""]
    wrong = spark.createDataFrame([(1, [15496, 60_000])], "k int, ids array<int>")
    with pytest.raises(PythonException):
        byte_codec.decode_documents(wrong, RANKS).collect()


def test_codec_query_equals_the_library(spark):
    lib = library()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_byte_codec"](spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = lib.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())
