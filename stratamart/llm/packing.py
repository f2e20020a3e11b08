"""Packing documents into sequences of fixed length.

Documents become token ids, are cut into pieces of at most one sequence, and the pieces are packed by first-fit
decreasing. The first bin with enough room is found by walking down a tournament tree whose inner nodes hold the largest
capacity below them. Packing runs independently in groups to which pieces are dealt at random (by the position of the
piece in its input partition, so that equal rows spread as well); a group holds about ``group_pieces`` documents' pieces,
whatever the size of the input, and wastes at most part of a few bins.

Texts are tokenised through their chunks: a chunk ends where the tokenizer's own rules always end a token, so that equal
chunks have equal ids, and the library encodes each chunk once for a task (and again after it left the bounded cache, which
holds chunks of up to 64 characters only).

Defined results: a null or empty text is a document of the end id alone; repeated rows are packed each time; an empty table
gives an empty table; other columns are not read. Texts are processed whole. The input has to give its rows in the same
order when a task is repeated, as stored tables do; otherwise store it first.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import map_slices, texts
from stratamart.llm.token_counts import AFTER_WORD, LATIN, SPACE


class ChunkEncoder:
    """Ids of whole texts for a tokenizer file whose pre-tokeniser drops white space and parts letters from the rest."""

    #: White space parts chunks; Latin letters end where ASCII punctuation, digits or white space follow.
    _chunks = re.compile(rf"[{LATIN}]+{AFTER_WORD}|[^{SPACE}]+")

    def __init__(self, path: str, limit: int = 200_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.longest, self.known, self.old = Tokenizer.from_file(path), limit, longest, {}, {}
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def encode(self, rows: list[str]) -> list[bytes]:
        """For each text, its ids as little-endian unsigned 32-bit integers."""
        split = [self._chunks.findall(t) for t in rows]
        known, old, missing = self.known, self.old, []
        for chunk in set().union(*split) - known.keys():
            ids = old.get(chunk)
            if ids is None:
                missing.append(chunk)
            else:
                known[chunk] = ids
        for chunk, e in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)):
            ids = e.ids
            known[chunk] = struct.pack(f"<{len(ids)}I", *ids)
        out = [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        for chunk in missing:
            if len(chunk) > self.longest:
                del known[chunk]
        if len(known) >= self.limit:  # the older half of what is remembered goes
            self.old, self.known = known, {}
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def cut(df: DataFrame, path: str, end_id: int, length: int, key: str = "doc_id", text: str = "text",
        keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids: key, start, length, ids_crc32, doc_tokens, lane (and ids, as binary).

    ``lane`` is a pseudo-random number for dealing pieces to groups.
    """
    end = struct.pack("<I", end_id)

    def factory():
        tokens, task = encoder(path), TaskContext.get()
        seat = ((task.partitionId() if task else 0) + 1) << 40

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal seat
            rows, out = tokens.encode(texts(batch.column(1))), []
            for i, ids in enumerate(rows):
                ids += end
                for at in range(0, len(ids), 4 * length):
                    piece = ids[at:at + 4 * length]
                    seat += 1
                    out.append((i, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, _mixed(seat), piece))
            columns = list(zip(*out))
            made = [pa.array(c, pa.int64()) for c in columns[1:6]] + ([pa.array(columns[6], pa.binary())] if keep_ids else [])
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0])), *made], names=names)
        return work

    names = [key, "start", "length", "ids_crc32", "doc_tokens", "lane", *["ids"] * keep_ids]
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} long" for n in names[1:6])
    return map_slices(df.select(F.col(key), F.col(text).alias("__text")), factory, schema + ", ids binary" * keep_ids)


def _mixed(x: int) -> int:
    """A well-mixed 62-bit number (multiply and shift)."""
    x = (x * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 29
    x = (x * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 32)) >> 2


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """For each item its bin and its offset in that bin. Items no larger than the capacity; ties keep their order."""
    n = len(sizes)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = [capacity] * (2 * leaves)
    bins, offsets = [0] * n, [0] * n
    for item in sorted(range(n), key=lambda i: -sizes[i]):
        size, node = sizes[item], 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pack(pieces: DataFrame, groups: int, length: int) -> DataFrame:
    """Add sequence_id and offset to pieces (columns length and lane; lane goes). A sequence never spans two groups."""
    kept = [f for f in pieces.schema.fields if f.name != "lane"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    names = [f.name for f in kept]

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lane"], kind="stable")
        bins, offsets = first_fit_decreasing(rows["length"].tolist(), length)
        group = int(rows["__group"].iloc[0])
        return rows[names].assign(sequence_id=(group << 32) + np.array(bins, "int64"), offset=np.array(offsets, "int64"))

    return pieces.withColumn("__group", F.col("lane") % F.lit(groups)).groupBy("__group").applyInPandas(place, schema)


def pack_documents(df: DataFrame, path: str, end_id: int = 2, length: int = 4096, group_pieces: int = 8192,
                   key: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row for each piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    groups = max(1, -(-df.count() // group_pieces))
    return pack(cut(df, path, end_id, length, key, text, keep_ids), groups, length)
