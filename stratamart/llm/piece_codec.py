"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the piece they would form (ties: leftmost) and
merges the best pair until none is left; what is not in the vocabulary then falls back to byte pieces. A text is first cut
between characters that stand side by side in no piece, as no merge can cross such a place; equal segments are encoded
once and remembered. Every segment that is new to a task is checked against the sentencepiece library, one call for each
slice of an Arrow batch, in both directions; a difference ends the job instead of passing on.

Defined results: a null text counts as empty (begin and end id only); a repeated row gives its result each time; an empty
table gives an empty table; other columns are not read. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import re
import struct
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import Memo, map_slices, texts

MARK = "▁"
UNKNOWN_TEXT = " \u2047 "
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the published model format


def fields(data: bytes):
    """(number, value) of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value, at = data[at:at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = data[at:at + size], at + size
        yield tag >> 3, value


class PieceCodec:
    """Encoder and decoder for one ``.model`` file of merge type with byte fallback."""

    def __init__(self, path: str, limit: int = 250_000):
        with open(path, "rb") as f:
            model = f.read()
        self.names, self.scores, self.types = [], {}, []
        self.dummy_prefix, trained = True, {}
        for number, value in fields(model):
            if number == 1:
                piece = dict(fields(value))
                self.names.append(piece[1].decode("utf-8"))
                self.types.append(piece.get(3, NORMAL))
                if self.types[-1] == NORMAL:
                    self.scores[self.names[-1]] = struct.unpack("<f", piece[2])[0]
            elif number == 2:
                trained = dict(fields(value))
            elif number == 3:
                norm = dict(fields(value))
                if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1):
                    raise ValueError("only models that leave white space and characters as they are")
                self.dummy_prefix = bool(norm.get(3, 1))
        if trained.get(3) != 2 or not trained.get(35) or trained.get(24) or {USER, UNUSED} & {*self.types}:
            raise ValueError(f"{path} is not a plain merge-type model with byte fallback")
        self.begin, self.end = trained.get(41, 1), trained.get(42, 2)
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.names, self.types)) if t == NORMAL}
        self.byte_ids = {int(p[3:-1], 16): i for i, (p, t) in enumerate(zip(self.names, self.types)) if t == BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        unknown = trained[44].decode("utf-8") if 44 in trained else UNKNOWN_TEXT
        self.plain = [p.replace(MARK, " ") if t == NORMAL else unknown if t == UNKNOWN else ""
                      for p, t in zip(self.names, self.types)]
        self.cuts = self._cut_pattern()
        self.memo, self.fresh = Memo(self._segment, limit), []
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        inside = {c for p in self.ids for c in p}
        self.guard = next(c for c in map(chr, [10, *range(0xE000, 0xF8FF)]) if c not in inside)
        self.guard_ids = self.library.encode(self.guard)

    def _cut_pattern(self) -> re.Pattern:
        """Segments: between them stand only pairs of characters that no piece contains."""
        pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        inside = {c for p in self.ids for c in p}
        letters = {c for c in inside if c.isalpha() and ord(c) < 0x250}
        if any(b == MARK and a != MARK for a, b in pairs):
            return re.compile(r"(?s).+")
        if "\n" in inside:
            return re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
        ends = "".join(c for c in map(chr, range(33, 127)) if not c.isalpha() and not any(a + c in pairs for a in letters))
        word = "".join(map(re.escape, sorted(letters)))
        return re.compile(rf"{MARK}*[{word}]+(?=[{re.escape(ends)}])|\n|{MARK}*[^{MARK}\n]+|{MARK}+")

    def _merge(self, segment: str) -> list[str]:
        symbols, score = list(segment), self.scores.get
        n = len(symbols)
        agenda = [(-s, i, 2) for i in range(n - 1) if (s := score(symbols[i] + symbols[i + 1])) is not None]
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            _, i, size = heappop(agenda)
            left, j = symbols[i], after[i]
            if not left or j >= n or len(left) + len(symbols[j]) != size:
                continue
            both = symbols[i] = left + symbols[j]
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (s := score(both + symbols[k])) is not None:
                    heappush(agenda, (-s, i, size + len(symbols[k])))
            h = before[i]
            if h >= 0 and (s := score(symbols[h] + both)) is not None:
                heappush(agenda, (-s, h, size + len(symbols[h])))
        return [s for s in symbols if s]

    def _ids(self, segment: str) -> list[int]:
        out = []
        for piece in self._merge(segment):
            i = self.ids.get(piece)
            if i is None:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8", "replace"))
            else:
                out.append(i)
        return out

    def _text(self, ids) -> str:
        """Pieces side by side; a run of byte pieces is read as UTF-8, a byte that fits nowhere as U+FFFD."""
        out, run = [], bytearray()
        for i in ids:
            b = self.bytes_of.get(i)
            if b is None:
                if run:
                    out.append(_utf8(run))
                    run.clear()
                out.append(self.plain[i])
            else:
                run.append(b)
        if run:
            out.append(_utf8(run))
        return "".join(out)

    def _segment(self, segment: str) -> tuple[bytes, str]:
        ids = self._ids(segment)
        result = np.array(ids, "<u4").tobytes(), self._text(ids)
        self.fresh.append((segment, ids, result[1]))
        return result

    def _segments(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cuts.findall((MARK if self.dummy_prefix else "") + text.replace(" ", MARK))

    def encode(self, text: str) -> list[int]:
        """The ids, with begin and end id."""
        return [self.begin, *np.frombuffer(b"".join(self.memo[s][0] for s in self._segments(text)), "<u4").tolist(), self.end]

    def decode(self, ids) -> str:
        """The text of any ids; control ids have none, and the white space put before the first word goes."""
        first = next((i for i in ids if self.types[i] != CONTROL), None)
        skip = self.dummy_prefix and first is not None and self.names[first].startswith(MARK)
        return self._text(ids)[skip:]

    def round_trip(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the text decoded from them."""
        parts = list(map(self.memo.__getitem__, self._segments(text)))
        ids = b"".join([struct.pack("<I", self.begin), *[p[0] for p in parts], struct.pack("<I", self.end)])
        return ids, "".join([p[1] for p in parts])[self.dummy_prefix:]

    def check(self) -> None:
        """Hold the segments encoded since the last call against the library."""
        if not self.fresh:
            return
        seen = self.library.encode([self.guard + s.replace(MARK, " ") for s, _, _ in self.fresh], num_threads=1)
        back = self.library.decode(seen, num_threads=1)
        skip = len(self.guard_ids)
        for (segment, ids, text), theirs, decoded in zip(self.fresh, seen, back):
            if theirs[:skip] != self.guard_ids or theirs[skip:] != ids or decoded != self.guard + text:
                raise ValueError(f"encoding differs from the library's: {segment[:80]!r}")
        self.fresh.clear()


def _utf8(run: bytes) -> str:
    """Decode, with one U+FFFD for every byte that belongs to no character."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError as e:
        return run[:e.start].decode("utf-8") + "�" + _utf8(run[e.start + 1:])


@lru_cache(maxsize=1)
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def encode_decode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ids (array, with begin and end id) and decoded (text) of every row."""
    return _mapped(df, path, key, text, "ids array<int>, decoded string", lambda ids, decoded: (
        np.frombuffer(ids, "<u4").astype("int32").tolist(), decoded), [pa.list_(pa.int32()), pa.string()])


def encode_digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`encode_decode`, but the number of ids and the SHA-256 of ids and decoded text instead of both."""
    return _mapped(df, path, key, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", lambda ids, decoded: (
        len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest()),
        [pa.int64(), pa.string(), pa.string()])


def _mapped(df: DataFrame, path: str, key: str, text: str, columns: str, result, types: list) -> DataFrame:
    names = [c.split(" ")[0] for c in columns.split(", ")]

    def factory():
        pieces = codec(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [result(*pieces.round_trip(t)) for t in texts(batch.column(1))]
            pieces.check()
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
            return pa.RecordBatch.from_arrays([batch.column(0), *made], names=[key, *names])
        return work

    rows = df.select(F.col(key), F.col(text).alias("__text"))
    return map_slices(rows, factory, f"`{key}` {df.schema[key].dataType.simpleString()}, {columns}")
