"""Exact BM25 top-k search with block-max pruning.

Documents stay in the partitions they are read in. A task builds inverted indexes over shards of at most ``shard_docs``
documents: postings sorted by term and block, with the maximum impact of each term in each block of ``BLOCK`` documents.
Within a shard documents are ordered by their most frequent term and their length, so that blocks are alike. For a query
the block maxima of its terms add up to an upper bound for each block (the pivot test of block-max WAND, made for whole
blocks at a time). A single query's most promising blocks are scored first; their k-th best score, or that of earlier
shards of the task, is the threshold, and only blocks whose bound reaches it are scored at all. Queries that share terms go
in batches: what rare terms add comes from their postings, common terms are rows of a matrix, which are multiplied,
a few blocks at a time, with the weights of those queries whose bound one of the blocks passes. Each task returns its k best for
each query, and the shards' results are merged by score. Document frequencies, the number of documents and their mean length
are those of all documents, so the merged result is exact.

Queries go in blocks of about ``BLOCK_TERMS`` (query, term) pairs, the only thing that is broadcast, with one weight for
each term; every block is held against all documents.

Terms are the words (runs of characters other than ASCII white space) with A-Z lower-cased, as 64-bit hashes. A query is
the set of terms of its text. Scores are rounded to ``DIGITS`` decimals; ties go to the smaller key.

Defined results: null or empty texts are documents of length 0 that match nothing, as queries they have no rows; queries
without a key are left out; documents without a key count in the statistics but are no results; repeated rows are results
of their own; an empty table gives an empty table; other columns are not read. Texts are indexed whole.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import map_slices, staged, texts

BLOCK, BLOCK_TERMS, DIGITS = 64, 4_000_000, 6
BATCH, BATCH_TERMS = 128, 100_000
"""Queries that are held against a shard together, and their terms (a longer query is a batch of its own)."""
COMMON, MOST_COMMON = 0.02, 500
"""Terms that at least this share of a shard's documents have are rows of a matrix, if they are not too many."""
DENSE_GAIN = 300
"""So much cheaper is a product in a matrix than one from a posting."""
GROUP = 8
"""Blocks whose rows are multiplied at a time, for the queries that may have results in one of them."""
POSTINGS = 300_000
"""Postings that are added up at a time."""
MANY = 4
"""With so many times k hits in a group of blocks, a query's k-th best is looked for first."""
COUNTED = 1_000_000
"""Terms of documents, once each, that a task collects before it passes their counts on."""


def term_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def term_statistics(df: DataFrame, text: str) -> DataFrame:
    """term, docs (documents with it); one more row with a null term has the number of documents and of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("term", pa.int64()), ("docs", pa.int64()), ("words", pa.int64())])

        def made(found: list[np.ndarray]) -> pa.RecordBatch:
            terms, docs = np.unique(np.concatenate([*found, np.empty(0, np.int64)]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(docs, pa.int64()), pa.array(np.zeros(len(terms), np.int64))], schema=schema)
        found, held, docs, words = [], 0, 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for t in texts(batch.column(0).slice(start, 256)):
                    h = term_hashes(t)
                    docs, words = docs + 1, words + len(h)
                    found.append(np.unique(h))
                    held += len(found[-1])
                if held > COUNTED:
                    yield made(found)
                    found, held = [], 0
        yield made(found)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([docs], pa.int64()), pa.array([words], pa.int64())], schema=schema)

    counts = df.select(text).mapInArrow(count, "term long, docs long, words long")
    return counts.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words"))


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """query, term: the distinct terms of each query."""

    def factory():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [np.unique(term_hashes(t)) for t in texts(batch.column(1))], pa.list_(pa.int64()))], names=["query", "terms"])
        return work

    kind = queries.schema[key].dataType.simpleString()
    found = map_slices(queries.where(F.col(key).isNotNull()).select(key, text), factory, f"query {kind}, terms array<long>")
    return found.select("query", F.explode("terms").alias("term"))


class Shard:
    """An inverted index of some documents, for the terms in ``vocabulary`` (sorted)."""

    def __init__(self, keys: list, docs: list[np.ndarray], vocabulary: np.ndarray, k1: float, b: float, mean: float):
        lengths = np.array([len(d) for d in docs], np.int64)
        words = np.concatenate([*docs, np.empty(0, np.int64)])
        owner = np.repeat(np.arange(len(docs)), lengths)
        term = np.searchsorted(vocabulary, words)
        term[term == len(vocabulary)] = 0
        known = vocabulary[term] == words
        del words
        pairs, tf = np.unique(owner[known] * len(vocabulary) + term[known], return_counts=True)
        owner, term = pairs // len(vocabulary), pairs % len(vocabulary)
        top = np.full(len(docs), -1, np.int64)
        by_tf = np.argsort(tf, kind="stable")
        top[owner[by_tf]] = term[by_tf]  # the last one written is the most frequent
        order = np.lexsort((lengths, top))
        place = np.empty(len(docs), np.int64)
        place[order] = np.arange(len(docs))
        self.keys = np.array(keys)[order]
        norm = k1 * (1 - b + b * lengths[owner] / mean)
        doc = place[owner]
        by_term = np.lexsort((doc, term))
        self.doc, term = doc[by_term], term[by_term]
        self.impact = (tf * (k1 + 1) / (tf + norm))[by_term]
        self.blocks = -(-len(docs) // BLOCK)
        block = self.doc // BLOCK
        first = np.ones(len(term), bool)
        first[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        self.start = np.flatnonzero(first)
        self.size = np.diff(np.append(self.start, len(term)))
        self.entry_block = block[self.start]
        self.entry_max = np.maximum.reduceat(self.impact, self.start) if len(term) else np.empty(0)
        self.entry_of = np.searchsorted(term[self.start], np.arange(len(vocabulary) + 1))
        counts = np.bincount(term, minlength=len(vocabulary))
        self.posting_of = np.append(0, np.cumsum(counts))
        # Terms that many documents have, as rows of a matrix, with their maxima in each block.
        common = np.flatnonzero(counts >= max(1, COMMON * len(docs)))
        if len(common) > MOST_COMMON:
            common = np.sort(common[np.argpartition(-counts[common], MOST_COMMON)[:MOST_COMMON]])
        self.docs_with = counts[common]
        self.row_of = np.full(len(vocabulary), -1, np.int32)
        self.row_of[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.blocks, BLOCK))
        row = self.row_of[term]
        dense = np.flatnonzero(row >= 0)
        self.rows.reshape(len(common), self.blocks * BLOCK)[row[dense], self.doc[dense]] = self.impact[dense]
        self.maxima = self.rows.max(2) if len(common) else np.zeros((0, self.blocks))

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(scores, keys) of all documents that may be among the k best, given that ``threshold`` is reached k times already."""
        starts = self.entry_of[terms]
        entries, weight = _ranges(starts, self.entry_of[terms + 1] - starts, weights)
        if not len(entries):
            return np.empty(0), self.keys[:0]
        block = self.entry_block[entries]
        bound = np.bincount(block, weight * self.entry_max[entries], self.blocks)
        slack = 10.0 ** -DIGITS
        alive = np.zeros(self.blocks, bool)
        if threshold <= 0 and self.blocks > 4:
            alive[np.argpartition(-bound, 3)[:4]] = True
            first = self._scores(entries, weight, alive[block])
            if len(first) >= k:
                threshold = np.partition(first, len(first) - k)[len(first) - k]
        alive = (bound >= threshold - slack) & (bound > 0)
        if not alive.any():
            return np.empty(0), self.keys[:0]
        scores = np.round(self._scores(entries, weight, alive[block]), DIGITS)
        hit = np.flatnonzero((scores > 0) & (scores >= threshold - slack))
        if len(hit) > k:
            least = np.partition(scores[hit], len(hit) - k)[len(hit) - k]
            hit = hit[scores[hit] >= least]
        return scores[hit], self.keys[hit]

    def _scores(self, entries: np.ndarray, weight: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        chosen = entries[wanted]
        postings, w = _ranges(self.start[chosen], self.size[chosen], weight[wanted])
        return np.bincount(self.doc[postings], w * self.impact[postings], len(self.keys))

    def best_of_batch(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, thresholds: np.ndarray,
                      k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`best` of many queries at once: (query, score, key).

        Terms that few queries or documents have are added up from their postings.  The others are rows of a matrix: the maxima of
        their blocks complete the bounds, and what no bound keeps is not multiplied.

        The queries are numbered from 0, as many as there are thresholds; ``query``, ``term`` and ``weight`` list their terms.
        """
        n, width = len(thresholds), self.blocks * BLOCK
        row = self.row_of[term]
        common = row >= 0
        asked = np.bincount(row[common], minlength=len(self.docs_with))
        # A row is multiplied for all queries and documents: that pays if many of both have the term.
        used = np.flatnonzero(asked * self.docs_with * DENSE_GAIN > n * len(self.keys))
        column = np.full(len(self.docs_with) + 1, -1)  # the last one is that of the other terms
        column[used] = np.arange(len(used))
        column = column[row]
        common = column >= 0
        weights = np.zeros((n, len(used)))
        weights[query[common], column[common]] = weight[common]
        scores = self._added(query[~common], term[~common], weight[~common], n, width).reshape(n, self.blocks, BLOCK)
        bound = scores.max(2) + weights @ self.maxima[used]
        slack = 10.0 ** -DIGITS
        thresholds, results = thresholds.copy(), []
        for lo in range(0, self.blocks, GROUP):
            bounds = bound[:, lo:lo + GROUP]
            queries = np.flatnonzero(((bounds >= thresholds[:, None] - slack) & (bounds > 0)).any(1))
            if not len(queries):
                continue
            part = scores[queries, lo:lo + GROUP].reshape(len(queries), -1)
            if len(used):
                part += weights[queries] @ self.rows[used, lo:lo + GROUP].reshape(len(used), -1)
            hits = (part >= thresholds[queries, None] - slack) & (part > 0)
            many = np.flatnonzero(np.count_nonzero(hits, 1) > MANY * k)
            if len(many):
                least = np.partition(part[many], part.shape[1] - k, axis=1)[:, part.shape[1] - k]
                hits[many] &= part[many] >= least[:, None] - slack
                thresholds[queries[many]] = np.maximum(thresholds[queries[many]], least)
            found, place = np.nonzero(hits)
            results.append((queries[found], np.round(part[found, place], DIGITS), self.keys[lo * BLOCK + place]))
        if not results:
            return np.empty(0, np.int64), np.empty(0), self.keys[:0]
        return tuple(np.concatenate(column) for column in zip(*results))

    def _added(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, width: int) -> np.ndarray:
        """What these terms add to each document, query after query, from their postings."""
        starts = self.posting_of[term]
        sizes = self.posting_of[term + 1] - starts
        some = np.flatnonzero(sizes)
        query, weight, starts, sizes = query[some].astype(np.int64) * width, weight[some], starts[some], sizes[some]
        ends = np.cumsum(sizes)
        scores = np.zeros(n * width)
        cuts = np.searchsorted(ends, np.arange(POSTINGS, ends[-1], POSTINGS)) if len(ends) else []
        for lo, hi in itertools.pairwise([0, *cuts, len(ends)]):
            if lo < hi:
                posting, w = _ranges(starts[lo:hi], sizes[lo:hi], weight[lo:hi])
                place = self.doc[posting] + np.repeat(query[lo:hi], sizes[lo:hi])
                np.add.at(scores, place, w * self.impact[posting])
        return scores


def _ranges(starts: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the ranges [start, start + size), one after the other, each with its range's weight."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + sizes, sizes), np.repeat(weights, sizes)


class Results:
    """The k best documents found so far for a batch of queries."""

    def __init__(self, query: np.ndarray, term: np.ndarray, n: int, k: int):
        self.terms, self.k, self.thresholds = (query, term), k, np.zeros(n)
        self.query, self.score, self.key = np.empty(0, np.int64), np.empty(0), None

    def search(self, shard: Shard, weights: np.ndarray) -> None:
        query, term = self.terms
        if len(self.thresholds) == 1:  # a matrix would serve one query only
            score, key = shard.best(term, weights[term], self.k, self.thresholds[0])
            query = np.zeros(len(score), np.int64)
        else:
            query, score, key = shard.best_of_batch(query, term, weights[term], self.thresholds, self.k)
        some = np.flatnonzero(score > 0)
        if not len(some):
            return
        query, score, key = query[some], score[some], key[some]
        if self.key is not None:
            query, score, key = np.append(self.query, query), np.append(self.score, score), np.append(self.key, key)
        order = np.lexsort((key, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        order, query, rank = order[rank < self.k], query[rank < self.k], rank[rank < self.k]
        self.query, self.score, self.key = query, score[order], key[order]
        full = rank == self.k - 1
        self.thresholds[query[full]] = self.score[full]


def bm25_topk(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75, key: str = "doc_id",
              text: str = "text", query_key: str = "doc_id", query_text: str = "text", shard_docs: int = 4_096) -> DataFrame:
    """query, rank (from 1), the document's key and its score, for the k best documents of each query."""
    spark = docs.sparkSession
    kind, query_kind = docs.schema[key].dataType.simpleString(), queries.schema[query_key].dataType.simpleString()
    wanted = query_terms(queries, query_key, query_text)
    wanted = staged(wanted, "query-terms")
    statistics = term_statistics(docs, text)
    asked = wanted.select("term").distinct().withColumn("asked", F.lit(True))
    needed = staged(statistics.join(asked, "term", "left").where("asked or term is null").drop("asked"), "term-statistics")
    total = needed.where("term is null").first()
    n, mean = (total["docs"], total["words"] / max(total["docs"], 1) or 1.0) if total else (0, 1.0)
    pairs = wanted.join(needed, "term").select("query", "term", F.log(1 + (F.lit(n) - F.col("docs") + 0.5) / (F.col("docs") + 0.5)).alias("weight"))
    blocks = max(1, math.ceil(wanted.count() / BLOCK_TERMS))
    pairs = staged(pairs.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks))), "query-weights")
    tasks = max(2 * spark.sparkContext.defaultParallelism, n // (16 * shard_docs) + 1)
    source = docs.where(F.col(key).isNotNull()).select(key, text).coalesce(tasks)
    schema = f"query {query_kind}, doc {kind}, score double"
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        asked = pairs.where(F.col("block") == block)
        rows = asked.select("query", "term").toArrow()
        if not rows.num_rows:
            continue
        query, term = (rows.column(i).to_numpy() for i in range(2))
        del rows
        # The weight of a term is the same in all queries.
        vocabulary, weights = (c.to_numpy() for c in asked.groupBy("term").agg(F.first("weight")).toArrow().columns)
        order = np.argsort(vocabulary)
        vocabulary, weights = vocabulary[order], weights[order]
        term = np.searchsorted(vocabulary, term).astype(np.int32)
        names, query = np.unique(query, return_inverse=True)
        # Queries of one batch should share their terms, so they are ordered by the term that most documents have.
        lightest = np.lexsort((weights[term], query))
        lightest = term[lightest[np.searchsorted(query[lightest], np.arange(len(names)))]]
        place = np.empty(len(names), np.int64)
        place[np.argsort(lightest, kind="stable")] = np.arange(len(names))
        names, query = names[np.argsort(place)], place[query]
        order = np.lexsort((term, query))
        starts = np.searchsorted(query[order], np.arange(len(names) + 1))
        shared = spark.sparkContext.broadcast((vocabulary, weights, names, starts, term[order]))
        del query, term, order, lightest, place
        found = found.unionByName(source.mapInArrow(_searching(shared, k, k1, b, mean, shard_docs), schema))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query", "rank", F.col("doc").alias(key), "score"))


def _batches(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of queries, of few queries and few terms each."""
    lo = 0
    for hi in range(1, len(starts)):
        if hi == len(starts) - 1 or hi - lo >= BATCH or starts[hi + 1] - starts[lo] > BATCH_TERMS:
            yield lo, hi
            lo = hi


def _searching(shared, k: int, k1: float, b: float, mean: float, shard_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, names, starts, terms = shared.value
        results = []
        keys, docs, kinds = [], [], None

        def search() -> None:
            if not results:
                for lo, hi in _batches(starts):
                    term = terms[starts[lo]:starts[hi]]
                    query = np.repeat(np.arange(hi - lo, dtype=np.int32), np.diff(starts[lo:hi + 1]))
                    results.append((lo, Results(query, term, hi - lo, k)))
            shard = Shard(keys, docs, vocabulary, k1, b, mean)
            for _, found in results:
                found.search(shard, weights)
            keys.clear()
            docs.clear()

        for batch in batches:
            kinds = batch.schema.field(0).type
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                keys.extend(part.column(0).to_pylist())
                docs.extend(map(term_hashes, texts(part.column(1))))
                if len(keys) >= shard_docs:
                    search()
        if keys:
            search()
        for lo, found in results:
            if found.key is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[lo + found.query]), pa.array(found.key, kinds), pa.array(found.score)], names=["query", "doc", "score"])
    return run
