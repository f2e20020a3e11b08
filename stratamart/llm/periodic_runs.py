"""Stretches of words that repeat with a period, found on an enhanced suffix array of each text's words.

The suffixes of a text are sorted by doubling, and the common prefixes of neighbours come from the ranks of those rounds. In each
LCP interval of depth d, the suffixes i of all children but the largest ask, through the inverse suffix array, whether i + d or
i - d lies in the interval too: then two equal blocks of d words stand side by side (a square), and where the words after the two
blocks differ, it is the last square of its run. Rotating it to the left as far as the words allow gives the run. Squares of a
multiple of the period end at the same word and merge into the run of the smallest one. No tree is built.

Texts are worked on in bundles of a bounded number of words, a longer text on its own; a text's suffixes are sorted among
themselves only, so copies do not slow each other down. Time is O(n log^2 n) for any text, memory O(n log n).

Defined results: a null text, and one without words, has no runs and an empty collapsed text; null keys and repeated rows are rows
like any other; an empty table gives an empty table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import map_slices, texts

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BUNDLE_WORDS = 400_000


def _sorted_suffixes(word: np.ndarray, doc: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by (text, words), and the ranks by the first 1, 2, 4, .. words; ``left`` counts words to the text's end."""
    n = len(word)
    order = np.lexsort((word, doc))
    fresh = np.ones(n, bool)
    fresh[1:] = (word[order[1:]] != word[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    # The rank of a suffix is the place of its group's first member, so later rounds only refine within groups.
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    ranks, width = [rank], 1
    while True:
        rank = ranks[-1]
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        places = np.flatnonzero(tied)
        if not len(places):
            return order, ranks
        suffix = order[places]
        further = np.full(len(suffix), -1, np.int64)  # a suffix that ends here comes first
        inside = left[suffix] > width
        further[inside] = rank[suffix[inside] + width]
        resorted = np.lexsort((further, rank[suffix]))
        suffix, further = suffix[resorted], further[resorted]
        order[places] = suffix
        group = rank[suffix]
        apart = np.ones(len(suffix), bool)
        apart[1:] = (group[1:] != group[:-1]) | (further[1:] != further[:-1])
        fresh[places] = apart
        refined = rank.copy()
        refined[suffix] = np.maximum.accumulate(np.where(apart, places, 0))
        ranks.append(refined)
        width *= 2


def _common_prefixes(order: np.ndarray, ranks: list[np.ndarray], doc: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Words shared by each suffix and the one sorted before it; -1 at the first suffix of a text."""
    a, b = order[:-1].copy(), order[1:].copy()
    ends = doc[a] != doc[b]
    shared = np.zeros(len(a), np.int64)
    last = len(doc) - 1
    for k in range(len(ranks) - 1, -1, -1):
        rank, width = ranks[k], 1 << k
        ai, bi = np.minimum(a, last), np.minimum(b, last)
        same = (rank[ai] == rank[bi]) & (shared + width <= np.minimum(left[order[:-1]], left[order[1:]]))
        shared[same] += width
        a[same] += width
        b[same] += width
    shared[ends] = -1
    return np.concatenate(([-1], shared, [-1]))


def _nearest_smaller(values: np.ndarray, step: int) -> np.ndarray:
    """For every entry, the nearest smaller one on the side of ``step`` (both ends hold the least value, -1)."""
    n = len(values)
    near = np.clip(np.arange(n) + step, 0, n - 1)
    active = np.flatnonzero(values >= 0)
    while len(active):
        active = active[values[near[active]] >= values[active]]
        # All entries passed over are at least as large, so jumping along their pointers is safe.
        near[active] = near[near[active]]
    return near


def _squares(order: np.ndarray, lcp: np.ndarray, word: np.ndarray, left: np.ndarray, max_depth: np.ndarray):
    """Starts and periods of the last square of every run, multiples of the period included."""
    n = len(order)
    isa = np.empty(n, np.int64)
    isa[order] = np.arange(n)
    splits = np.flatnonzero(lcp > 0)
    lows, highs = _nearest_smaller(lcp, -1)[splits], _nearest_smaller(lcp, 1)[splits]
    depth = lcp[splits]
    useful = depth <= max_depth[order[splits]]
    splits, lows, highs, depth = splits[useful], lows[useful], highs[useful], depth[useful]
    if not len(splits):
        return splits, depth
    by_interval = np.lexsort((splits, depth, lows))
    splits, lows, highs, depth = splits[by_interval], lows[by_interval], highs[by_interval], depth[by_interval]
    opens = np.ones(len(splits), bool)
    opens[1:] = (lows[1:] != lows[:-1]) | (depth[1:] != depth[:-1])
    # Children: one that begins at the interval's low end, and one that begins at each split.
    number = np.cumsum(opens) - 1
    heads = np.flatnonzero(opens)
    starts = np.concatenate((lows[heads], splits))
    owner = np.concatenate((np.arange(len(heads)), number))
    arranged = np.lexsort((starts, owner))
    starts, owner = starts[arranged], owner[arranged]
    low, high, deep = lows[heads], highs[heads], depth[heads]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:]
    lasts = np.flatnonzero(np.concatenate((owner[1:] != owner[:-1], [True])))
    ends[lasts] = high
    size = ends - starts
    by_size = np.lexsort((size, owner))
    small = np.ones(len(size), bool)
    small[by_size[np.concatenate((owner[by_size][1:] != owner[by_size][:-1], [True]))]] = False
    starts, size, owner = starts[small], size[small], owner[small]
    total = np.cumsum(size)
    if not len(total):
        return splits[:0], depth[:0]
    owner = np.repeat(owner, size)
    place = np.arange(total[-1]) - np.repeat(total - size, size) + np.repeat(starts, size)
    i, d, low, high = order[place], deep[owner], low[owner], high[owner]
    found = []
    for first in (i, i - d):
        second = first + d
        other = second if first is i else first
        inside = (other >= 0) & (other < n)
        where = isa[np.where(inside, other, 0)]
        # A suffix of the same interval belongs to the same text.
        hit = np.flatnonzero(inside & (where >= low) & (where < high))
        f, p = first[hit], d[hit]
        # The words after the two blocks differ, or the text ends: otherwise the square can be rotated to the right.
        end = f + 2 * p
        at_end = left[f] <= 2 * p
        differ = at_end | (word[np.minimum(end, n - 1)] != word[f + p])
        found.append(np.stack((f[differ], p[differ])))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pairs[0], pairs[1]


def _rotated(word: np.ndarray, start: int, period: int, floor: int) -> int:
    """How far to the left the words keep the period."""
    reach = 32
    while start > floor:
        low = max(floor, start - reach)
        unlike = np.flatnonzero(word[low:start] != word[low + period:start + period])
        if len(unlike):
            return low + int(unlike[-1]) + 1
        start, reach = low, reach * 2
    return start


def runs_of(bundle: list[list[str]], min_words: int, min_periods: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) of every text that has any, by the text's number and in order."""
    lengths = np.array([len(w) for w in bundle], np.int64)
    n = int(lengths.sum())
    if n == 0:
        return {}
    numbers = defaultdict(lambda: len(numbers))
    word = np.fromiter((numbers[w] for text in bundle for w in text), np.int64, n)
    doc = np.repeat(np.arange(len(bundle)), lengths)
    begins = np.cumsum(lengths) - lengths
    left = np.repeat(begins + lengths, lengths) - np.arange(n)
    order, ranks = _sorted_suffixes(word, doc, left)
    lcp = _common_prefixes(order, ranks, doc, left)
    starts, periods = _squares(order, lcp, word, left, np.repeat(lengths // min_periods, lengths))
    # A run that is long enough reaches this far to the left of its last square; one comparison spares most rotations.
    ends, needed = starts + 2 * periods, np.maximum(min_words, min_periods * periods)
    floors = begins[doc[starts]] if len(starts) else starts
    far = ends - needed
    keep = far >= floors
    keep[keep] = word[far[keep]] == word[far[keep] + periods[keep]]
    by_end = defaultdict(list)
    for start, period, end in zip(starts[keep].tolist(), periods[keep].tolist(), ends[keep].tolist()):
        by_end[end].append((period, start))
    out = defaultdict(list)
    for end, squares in by_end.items():
        known: list[tuple[int, int]] = []
        for period, start in sorted(squares):
            if any(period % q == 0 and end - low >= 2 * period for q, low in known):
                continue
            number = int(doc[start])
            low = _rotated(word, start, period, int(begins[number]))
            known.append((period, low))
            if end - low >= max(min_words, min_periods * period):
                out[number].append((low - int(begins[number]), end - low, period))
    return {number: sorted(found, key=lambda r: (r[0], r[2])) for number, found in out.items()}


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return " ".join(w for w, g in zip(words, gone.tolist()) if not g)


def periodic_runs(df: DataFrame, *, min_words: int = 6, min_periods: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, runs (array of start, length, period, in words) and the collapsed text of every row.

    A run has a smallest period q, at least ``min_words`` words and at least ``min_periods`` (2 or more) times q words, and cannot
    be extended on either side.
    """
    if min_periods < 2:
        raise ValueError("a run has at least two periods")
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def factory():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, short, bundle, size = [], [], [], 0

            def flush():
                runs = runs_of(bundle, min_words, min_periods)
                for i, words in enumerate(bundle):
                    mine = runs.get(i, [])
                    found.append([{"start": s, "length": n, "period": p} for s, n, p in mine])
                    short.append(collapsed(words, mine))
                bundle.clear()

            for t in texts(batch.column(1)):
                words = WORDS.findall(t)
                if bundle and size + len(words) > BUNDLE_WORDS:
                    flush()
                    size = 0
                bundle.append(words)
                size += len(words)
            flush()
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, run_type), pa.array(short, pa.string())],
                                              names=[key, "runs", "collapsed"])
        return work

    rows = df.select(F.col(key), F.col(text).alias("__text"))
    kind = df.schema[key].dataType.simpleString()
    return map_slices(rows, factory, f"`{key}` {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string")
