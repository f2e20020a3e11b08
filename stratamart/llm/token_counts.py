"""Token counts by byte-pair merging, without making the tokens.

A text is cut where no merge can reach (the pre-tokeniser's boundaries). For each piece, a heap holds the mergeable
adjacent pairs by rank and a linked list holds the symbols; popping the lowest rank until none is left gives the number
of merges, and the count is the number of initial symbols minus that. No identifiers are looked up.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a repeated row is counted again each time; an empty table
gives an empty table; other columns, whatever their names, are not read. Texts of any length are processed whole: the
merging of one piece is O(n log n), and only pieces of up to 64 characters are remembered.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import Memo, map_slices, texts

# The published pre-tokeniser pattern of byte-level BPE, and Unicode's white space.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of Latin letters that ends at ASCII punctuation, a digit, white space or the end ends a piece as well.
LATIN = r"A-Za-zÀ-ÖØ-öø-ÿ"
AFTER_WORD = r"(?=[!-@\[-`{-~" + SPACE + r"]|\Z)"


def byte_alphabet() -> list[str]:
    """One printable character for each byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class PairCounter:
    """Counts tokens of whole texts for one tokenizer file (byte-level BPE, ``.json``)."""

    #: Spans whose inner boundaries the pattern above respects; cheaper than the full pattern, and remembered.
    _chunks = re.compile(rf" ?[{LATIN}]+{AFTER_WORD}| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or not before.get("use_regex", True) \
                or before.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        added = spec.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take in white space or whole words only are not handled")
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.letters = byte_alphabet()
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pattern = regex.compile(BYTE_LEVEL)
        self.pieces = Memo(self._merge, limit=100_000)
        self.chunks = Memo(lambda c: sum(map(self.pieces.__getitem__, self.pattern.findall(c))))

    def _merge(self, piece: str) -> int:
        symbols = [self.letters[b] for b in piece.encode("utf-8", "replace")]
        n = len(symbols)
        rank_of = self.ranks.get
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank_of((a, b))) is not None]
        heapify(heap)
        after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            merges += 1
            both = symbols[i] = a + b
            symbols[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of((both, symbols[k]))) is not None:
                    heappush(heap, (r, i, both, symbols[k]))
            h = before[i]
            if h >= 0 and (r := rank_of((symbols[h], both))) is not None:
                heappush(heap, (r, h, symbols[h], both))
        return n - merges

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return sum(map(self.chunks.__getitem__, self._chunks.findall(text)))
        rest = self.special.split(text)
        return len(rest) - 1 + sum(sum(map(self.chunks.__getitem__, self._chunks.findall(t))) for t in rest)


@lru_cache(maxsize=2)
def counter(path: str) -> PairCounter:
    return PairCounter(path)


def token_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes (UTF-8) and n_tokens of every row; ``path`` names the tokenizer file on every executor."""

    def factory():
        tokens = counter(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = texts(batch.column(1))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode("utf-8")) for t in rows], pa.int64()),
                 pa.array([tokens.count(t) for t in rows], pa.int64())], names=[key, "n_bytes", "n_tokens"])
        return work

    rows = df.select(F.col(key), F.col(text).alias("__text"))
    return map_slices(rows, factory, f"`{key}` {df.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long")
