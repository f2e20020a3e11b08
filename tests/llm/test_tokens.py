"""Token counts, SentencePiece and packing against the libraries."""

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from corpus_fixtures import SMALL, documents  # noqa: F401
from stratamart.llm.packing import ChunkEncoder, first_fit_decreasing, pack_documents
from stratamart.llm.piece_codec import PieceCodec, encode_decode
from stratamart.llm.token_counts import PairCounter, token_counts

BYTES, WORDS, PIECES = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = [*map(chr, (0, 9, 10, 11, 13, 28, 31, 32, 127, 0x85, 0xA0, 0x301, 0x3A3, 0x130, 0x1E9E, 0x200B, 0x2028, 0x2581, 0x3000,
                  0xFEFF, 0x1F600, 0x10FFFF)), *"abcXYZ'sdt.,!?<|>019²", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>",
       "<unk>", "<0x0A>", "'ll", "don't", "   ", "\n\n"]
SPECIAL = ["", " ", "a" * 20_000, "ab " * 5_000, "\n" * 500, " " * 500, "<|endoftext|>" * 9, "▁▁a ▁", "naïve Σίσυφος"]
text = st.lists(st.one_of(st.sampled_from(ODD), st.characters(exclude_categories=["Cs"])), max_size=40).map("".join)


@pytest.fixture(scope="module")
def tools():
    return {"bytes": (PairCounter(BYTES), Tokenizer.from_file(BYTES)), "words": (ChunkEncoder(WORDS), Tokenizer.from_file(WORDS)),
            "pieces": (PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES))}


@settings(max_examples=400, deadline=None)
@given(t=text)
def test_whole_texts_equal_the_libraries(tools, t):
    counter, library = tools["bytes"]
    assert counter.count(t) == len(library.encode(t, add_special_tokens=False).ids)
    chunks, library = tools["words"]
    assert np.frombuffer(chunks.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    codec, library = tools["pieces"]
    ids = library.encode(t, add_bos=True, add_eos=True)
    assert codec.encode(t) == ids and codec.decode(ids) == library.decode(ids)
    codec.check()


@pytest.mark.parametrize("t", SPECIAL, ids=range(len(SPECIAL)))
def test_special_texts(tools, t):
    test_whole_texts_equal_the_libraries.hypothesis.inner_test(tools, t)


def test_decoding_any_ids(tools):
    codec, library = tools["pieces"]
    rng = random.Random(5)
    for _ in range(2_000):
        ids = [rng.randint(0, 300) if rng.random() < 0.7 else rng.randint(0, 31_999) for _ in range(rng.randint(0, 9))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_a_difference_from_the_library_ends_the_job():
    codec = PieceCodec(PIECES)
    codec.scores = {p: -s for p, s in codec.scores.items()}
    codec.round_trip("some words that merge in another order")
    with pytest.raises(ValueError, match="differs"):
        codec.check()


ROWS = [(1, None), (2, ""), (3, "Some words."), (3, "Some words."), (None, "no id"), (5, "x" * 50_000), (6, "a b\n" * 3_000)]


def test_token_counts_rows(documents):
    library = Tokenizer.from_file(BYTES)
    got = [tuple(r) for r in token_counts(documents(ROWS), BYTES).collect()]
    assert got == [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    assert token_counts(documents([]), BYTES).count() == 0


def test_encode_decode_rows(documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for (i, t), r in zip(ROWS, encode_decode(documents(ROWS), PIECES).collect()):
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        assert (r["doc_id"], r["ids"], r["decoded"]) == (i, ids, library.decode(ids))
    assert encode_decode(documents([]), PIECES).count() == 0


def test_queries_equal_the_libraries(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    bpe, pieces = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in entry_points.queries()["op1_token_counts"](spark, SMALL).collect():
        n = len(bpe.encode(docs[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 1024)
    for r in entry_points.queries()["op2_sentencepiece"](spark, SMALL).collect():
        ids = pieces.encode(docs[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(pieces.decode(ids).encode()).hexdigest()


@given(sizes=st.lists(st.integers(1, 20), max_size=60))
def test_first_fit_decreasing_equals_a_plain_search(sizes):
    bins, offsets = first_fit_decreasing(sizes, 20)
    used, expected = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((b for b, u in enumerate(used) if u + sizes[i] <= 20), len(used))
        used += [0] * (b == len(used))
        expected[i] = (b, used[b])
        used[b] += sizes[i]
    assert {i: (b, o) for i, (b, o) in enumerate(zip(bins, offsets))} == expected


def packed_right(rows, docs, length):
    """Each id of each document in one piece, pieces gapless in their sequences."""
    library, by_doc, by_sequence = Tokenizer.from_file(WORDS), {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(docs)
    for doc, pieces in by_doc.items():
        ids, at = [*library.encode(docs[doc] or "", add_special_tokens=False).ids, 2], 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at:at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    used = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
        used += at
    return used / (length * len(by_sequence))


def test_packing_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert packed_right(entry_points.queries()["op8_packing"](spark, SMALL).collect(), docs, 4096) > 0.97


def test_packing_rows(documents):
    docs = {1: None, 2: "", 3: "Some words.", 5: "x y " * 4_000, 6: "word " * 15}
    kept = pack_documents(documents(list(docs.items())), WORDS, length=16, group_pieces=2, keep_ids=True).collect()
    packed_right(kept, docs, 16)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in kept)
    assert pack_documents(documents([]), WORDS).count() == 0
    twice = pack_documents(documents([(1, "same"), (1, "same"), (None, "no id")]), WORDS).collect()
    assert sorted((r["doc_id"] or 0) for r in twice) == [0, 1, 1] and len({(r["sequence_id"], r["offset"]) for r in twice}) == 3
