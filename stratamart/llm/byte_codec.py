"""Byte-level BPE over a whole corpus: every distinct word is encoded once, wherever it stands.

Encoding. Texts are cut into words (the pattern's matches) and gathered, as they come, into blocks of bounded size. A block
numbers its distinct words and explodes into one row for each of them, and it keeps the positions as one sequence of these
numbers, in chunks. The exploded rows of all blocks are shuffled by word. Sorted by it, equal words meet in one task, are encoded
once, by merging the adjacent pair of lowest rank, and every row gets the identifiers. The rows go back to their blocks, where
they are joined with the positions, and the texts are put together in order of position. However often a word stands in a block
it is one narrow row, so even a word that is in all texts has only as many rows as there are blocks.

Decoding joins every identifier, in its place, with the table of token bytes. That table has one row for each entry of the
vocabulary (50,256 here), a fixed size whatever the corpus, and an identifier is its row number: so every task has the table,
looks up all identifiers of some rows at once, and nothing is shuffled.

Encoding reads the input twice, once for the words and once for the positions, and numbers blocks by input partition. So the
input has to be a stored table, not the result of a shuffle.

Defined results: a null text counts as empty and has no identifiers; null keys and repeated rows are rows like any other; an empty
table gives an empty table; other columns, whatever their names, are not read. Texts and words of any length are encoded whole
(O(n log n) for a word of n bytes); a block is closed after a text that fills it, so memory is that of a block or of the
longest text. An identifier that the vocabulary lacks fails the decoding.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

READ_ROWS = 256


class Limits(NamedTuple):
    """What is held in memory at a time; results do not depend on it."""
    block_chars: int = 16_000_000
    chunk_words: int = 400_000
    held_words: int = 200_000



# Unicode's white space, the letters of Latin-1, and the published pattern of byte-level BPE.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATIN = r"A-Za-zÀ-ÖØ-öø-ÿ"
#: Spans at whose ends the published pattern always cuts. Most are single words, and each distinct one is cut once in a task.
SPANS = re.compile(rf" ?[{LATIN}]+(?=[!-@\[-`{{-~{SPACE}]|\Z)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# -- positions ---------------------------------------------------------------------------------------------------------

def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^32, their lowest bytes first, then the next ones: small numbers leave long runs of zeros."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(n)


def lists_of(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Items of a list or binary column in one array, and how many each row has."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks)
    if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
        return np.asarray(values.flatten()), np.diff(np.asarray(values.offsets)).astype(np.int64)
    wide = pa.types.is_large_binary(values.type)
    offsets = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    items = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return items, np.diff(offsets).astype(np.int64)


def in_sequence(numbers: np.ndarray, items: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The items of row ``numbers[0]``, then those of row ``numbers[1]`` and so on; and how many each of them has."""
    starts, sizes = (np.cumsum(sizes) - sizes)[numbers], sizes[numbers]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return items[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)], sizes


def sums(counts: np.ndarray) -> np.ndarray:
    """0 and the running totals."""
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)))


def _as_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


# -- encoding ----------------------------------------------------------------------------------------------------------

class Ranks:
    """The rank file: token bytes and rank, which is the identifier."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.of = {base64.b64decode(token): int(rank) for token, rank in pairs}

    def encode(self, word: bytes) -> list[int]:
        """Merge the adjacent pair of lowest rank, the leftmost first, until none is in the table."""
        whole = self.of.get(word)
        if whole is not None:
            return [whole]
        n, rank_of = len(word), self.of.get
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        end = list(range(1, n + 1))  # where the symbol that begins here ends; 0: merged into another
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(word[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            j = after[i]
            if not end[i] or j >= n or end[j] != stop or end[i] != j:
                continue
            end[i], end[j] = stop, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(word[i:end[k]])) is not None:
                    heappush(heap, (r, i, end[k]))
            h = before[i]
            if h >= 0 and (r := rank_of(word[h:stop])) is not None:
                heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(self.of[word[i:end[i]]])
            i = after[i]
        return out


@lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


class _Numbers(dict):
    """Consecutive numbers for what is asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class _Block:
    """Texts whose distinct words are numbered together, in the order in which they first come up."""

    def __init__(self, pattern: str):
        self.cut = regex.compile(pattern).findall
        self.spans = SPANS.findall if pattern == WORD_PATTERN else self.cut
        self.span_no, self.numbers, self.size = _Numbers(), [], 0

    def add(self, text: str | None) -> None:
        found = self.spans(text) if text else []
        self.numbers.append(np.fromiter(map(self.span_no.__getitem__, found), np.int32, len(found)))
        self.size += len(text or "")

    def words(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct words, the words of all spans (by number) one after the other, and how many each span has."""
        word_no, inner, sizes = _Numbers(), [], []
        for span in self.span_no:
            pieces = [span] if self.spans is self.cut else self.cut(span)
            inner.extend(map(word_no.__getitem__, pieces))
            sizes.append(len(pieces))
        return list(word_no), np.array(inner, np.int32), np.array(sizes, np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, limits: Limits) -> Iterator[tuple[int, _Block, pa.Array]]:
    """(number of the block, block, keys of its texts); the same for the same rows."""
    part, serial, block, keys = TaskContext.get().partitionId(), 0, _Block(pattern), []
    for batch in batches:
        for start in range(0, batch.num_rows, READ_ROWS):
            rows, first = batch.slice(start, READ_ROWS), 0
            for i, text in enumerate(rows.column(1).to_pylist()):
                block.add(text)
                if block.size >= limits.block_chars:
                    keys.append(rows.column(0).slice(first, i + 1 - first))
                    yield (part << 32) + serial, block, pa.concat_arrays(keys)
                    first, serial, block, keys = i + 1, serial + 1, _Block(pattern), []
            keys.append(rows.column(0).slice(first))
    if block.numbers:
        yield (part << 32) + serial, block, pa.concat_arrays(keys)


def _word_rows(batches: Iterator[pa.RecordBatch], pattern: str, limits: Limits) -> Iterator[pa.RecordBatch]:
    """Every distinct word of every block, with its number there."""
    for number, block, _ in _blocks(batches, pattern, limits):
        block.numbers.clear()
        words, _, _ = block.words()
        for start in range(0, len(words), READ_ROWS * 64):
            some = words[start:start + READ_ROWS * 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), number)), pa.array(np.arange(start, start + len(some)), pa.int32()),
                 pa.array(some, pa.string())], names=["block", "number", "word"])


def _position_rows(batches: Iterator[pa.RecordBatch], pattern: str, limits: Limits) -> Iterator[pa.RecordBatch]:
    """The word numbers of every block in order of position, some texts to a row, with the texts' keys and word counts."""
    for number, block, keys in _blocks(batches, pattern, limits):
        words, inner, sizes = block.words()
        spans, first, gathered = [], 0, 0
        for i, found in enumerate(block.numbers):
            spans.append(found)
            gathered += len(found)
            if gathered < limits.chunk_words and i + 1 < len(block.numbers):
                continue
            sequence, per_span = in_sequence(np.concatenate(spans), inner, sizes)
            counts = np.diff(sums(per_span)[sums(np.array(list(map(len, spans)), np.int64))])
            texts = pa.record_batch([keys.slice(first, len(spans)), pa.array(counts, pa.int64())], names=["key", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([first], pa.int32()), pa.array([packed(sequence)], pa.binary()),
                 pa.array([_as_bytes(texts)], pa.binary())], names=["block", "chunk", "sequence", "texts"])
            spans, first, gathered = [], i + 1, 0


def _encoded(batches: Iterator[pa.RecordBatch], path: str, limits: Limits) -> Iterator[pa.RecordBatch]:
    """Rows sorted by word: each distinct word is encoded once, and every block gets the identifiers of those that it has.

    What goes to one block is gathered, up to ``held_words`` rows at a time.
    """
    table, last, ids = ranks(path), None, []
    held: dict[int, tuple[list, list]] = defaultdict(lambda: ([], []))
    size = 0

    def flush() -> pa.RecordBatch:
        numbers = [packed(np.array(n)) for n, _ in held.values()]
        sizes = [packed(np.array(list(map(len, found)))) for _, found in held.values()]
        flat = [packed(np.fromiter(chain.from_iterable(found), np.int64)) for _, found in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), *[pa.array(x, pa.binary()) for x in (numbers, sizes, flat)]],
                                          names=["block", "numbers", "sizes", "ids"])

    for batch in batches:
        for block, number, word in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if word != last:
                last, ids = word, table.encode(word.encode())
            mine = held[block]
            mine[0].append(number)
            mine[1].append(ids)
        size += batch.num_rows
        if size >= limits.held_words:
            yield flush()
            held.clear()
            size = 0
    if held:
        yield flush()


def encode_documents(df: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", pattern: str = WORD_PATTERN,
                     limits: Limits = Limits()) -> DataFrame:
    """``key`` and ids (array of int) of every row; ``path`` names the rank file on every executor."""
    kind = df.schema[key].dataType.simpleString()

    def joined_up(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")  # chunks in order, then the words
        chunks = rows.num_rows - rows.column("chunk").null_count
        words = [rows.column(c).slice(chunks).to_pylist() for c in ("numbers", "sizes", "ids")]
        number, sizes, items = (np.concatenate([np.empty(0, np.int64), *map(unpacked, x)]).astype(np.int64) for x in words)
        # By number: where the identifiers of each word are.
        order = np.argsort(number)
        if not np.array_equal(number[order], np.arange(len(number))):
            raise ValueError("a block lacks words")
        items, sizes = in_sequence(order, items, sizes)
        out = []
        for sequence, texts in zip(*(rows.column(c).slice(0, chunks).to_pylist() for c in ("sequence", "texts"))):
            texts = _from_bytes(texts)
            flat, per_word = in_sequence(unpacked(sequence), items, sizes)
            ends = sums(per_word)[sums(texts.column("n").to_numpy())]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            out.append(pa.table({key: texts.column("key"), "ids": lists}))
        return pa.concat_tables(out)

    rows = df.select(F.col(key), F.col(text).alias("__text"))
    words = rows.mapInArrow(lambda b: _word_rows(b, pattern, limits), "block long, number int, word string")
    words = words.repartition("word").sortWithinPartitions("word")
    words = words.mapInArrow(lambda b: _encoded(b, path, limits), "block long, numbers binary, sizes binary, ids binary")
    places = rows.mapInArrow(lambda b: _position_rows(b, pattern, limits), "block long, chunk int, sequence binary, texts binary")
    both = places.unionByName(words, allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(joined_up, f"`{key}` {kind}, ids array<int>")


# -- decoding ----------------------------------------------------------------------------------------------------------

def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The table of token bytes: those of all identifiers one after the other, and how many each has (-1: there is none)."""
    of = {rank: token for token, rank in ranks(path).of.items()}
    tokens = [of.get(i) for i in range(max(of) + 1)]
    sizes = np.array([-1 if t is None else len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8), sizes


def decode_documents(df: DataFrame, path: str, *, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """The frame with the bytes of its identifiers in place of them; null identifiers count as none."""
    kept = [c for c in df.columns if c != ids]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, sizes = token_bytes(path)
        for whole in batches:
            for start in range(0, whole.num_rows, READ_ROWS):
                batch = whole.slice(start, READ_ROWS)
                numbers, lengths = lists_of(batch.column(len(kept)).fill_null([]))
                if len(numbers) and (numbers.min() < 0 or numbers.max() >= len(sizes) or (sizes[numbers] < 0).any()):
                    raise ValueError("an identifier is not in the vocabulary")
                flat, per_id = in_sequence(numbers, items, np.maximum(sizes, 0))
                offsets = sums(per_id)[sums(lengths)]
                if offsets[-1] >= 1 << 31:
                    raise ValueError(f"{READ_ROWS} rows decode to more than 2 GB")
                found = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                    None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], found], names=[*kept, output])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    return df.select(*kept, ids).mapInArrow(decoded, f"{kinds}{', ' if kinds else ''}`{output}` binary")
