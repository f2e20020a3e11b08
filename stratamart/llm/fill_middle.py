"""Fill-in-the-middle: cut a text at two line ends and move its middle, or its suffix, to another place.

A text is laid out as fixed blocks of UTF-8 bytes. For each block, a Fenwick tree holds how many units (lines with their line
feed) end in it and how many code points begin in it. A cut after unit k is found by descending the tree in powers of two, which
gives the block and the code points before it; only that block is then searched for the line feed.

Defined results: a null text counts as empty; an empty text, and a text that contains a marker, stays as it is (form ``plain``,
null lengths); a null key is hashed as the empty string; repeated rows give repeated results; an empty table gives an empty
table; other columns, whatever their names, are not read. Texts of any length are cut whole; memory is a few copies of one text.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import map_slices

BLOCK_BYTES = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
FORMS = ("plain", "psm", "spm")


class Fenwick:
    """Prefix sums over several counts of each block at once."""

    def __init__(self, *counts: list[int]):
        self.size = len(counts[0])
        self.trees = []
        for values in counts:
            tree = [0, *values]
            for i in range(1, self.size + 1):
                above = i + (i & -i)
                if above <= self.size:
                    tree[above] += tree[i]
            self.trees.append(tree)
        self.top = 1 << max(0, self.size.bit_length() - 1)

    def descend(self, k: int) -> tuple[int, int, int]:
        """The block in which the k-th unit ends: its number, units ending there up to that one, second sum before it."""
        first, second = self.trees
        at, before, step = 0, 0, self.top
        while step:
            after = at + step
            if after <= self.size and first[after] < k:
                at, k, before = after, k - first[after], before + second[after]
            step >>= 1
        return at, k, before


class TextBlocks:
    """Where the units of one text end, in bytes and in code points."""

    def __init__(self, data: bytes, size: int = BLOCK_BYTES):
        self.data, self.size = data, size
        starts = range(0, len(data), size)
        self.begins = np.frombuffer(data, np.int8) > -65  # any byte but the continuation bytes 0x80 to 0xBF
        units = [data.count(b"\n", a, a + size) for a in starts]
        self.n_units = sum(units)
        if not data.endswith(b"\n"):
            units[-1] += 1
            self.n_units += 1
        self.tree = Fenwick(units, np.add.reduceat(self.begins, starts, dtype=np.int64).tolist())

    def after(self, k: int) -> tuple[int, int]:
        """End of unit ``k`` (0: the start) as byte offset and as number of code points before it."""
        if k == 0:
            return 0, 0
        block, left, chars = self.tree.descend(k)
        start = at = block * self.size
        for _ in range(left):
            at = self.data.find(b"\n", at) + 1
            if at == 0:  # the last unit has no line feed
                at = len(self.data)
        return at, chars + int(np.count_nonzero(self.begins[start:at]))


def _draws(seed: int, key: object) -> list[int]:
    text = f"{seed}:{'' if key is None else key}"
    hexed = sha256(text.encode()).hexdigest()
    return [int(hexed[i:i + 8], 16) for i in range(0, 32, 8)]


def _moved(key: object, data: bytes, seed: int, plain_from: int, spm_below: int) -> tuple:
    """n, form, code points of prefix and middle, output."""
    if not data:
        return 0, "plain", None, None, data
    blocks = TextBlocks(data)
    n = blocks.n_units
    h1, h2, h3, h4 = _draws(seed, key)
    if h3 % 100 >= plain_from or any(m.encode() in data for m in MARKERS):
        return n, "plain", None, None, data
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, chars_a), (b, chars_b) = blocks.after(first), blocks.after(last)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h4 % 100 < spm_below:
        form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    else:
        form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    return n, form, chars_a, chars_b - chars_a, b"".join(p.encode() if isinstance(p, str) else p for p in parts)


def fill_middle(df: DataFrame, *, seed: int, percent: int = 100, spm_percent: int = 50, key: str = "doc_id",
                text: str = "text") -> DataFrame:
    """``key``, n (units), form, prefix_chars, middle_chars and output of every row.

    ``percent`` of the texts are transformed, ``spm_percent`` of these with the suffix first; the draws come from a hash of
    ``seed`` and the key, so they are the same on every run.
    """

    def factory():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = batch.column(0).to_pylist()
            rows = [_moved(k, d or b"", seed, percent, spm_percent)
                    for k, d in zip(keys, batch.column(1).cast(pa.binary()).to_pylist())]
            n, form, prefix, middle, output = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                names=[key, "n", "form", "prefix_chars", "middle_chars", "output"])
        return work

    rows = df.select(F.col(key), F.col(text).alias("__text"))
    kind = df.schema[key].dataType.simpleString()
    return map_slices(rows, factory, f"`{key}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text again. A text that holds a marker is never transformed, so every marker in a transformed one is ours."""
    parts = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
