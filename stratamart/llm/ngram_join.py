"""Similarity join of documents on word n-grams (Jaccard), as components.

A document's set holds its distinct n-grams of ``words`` words, as 64-bit hashes; a text with fewer words is one n-gram. Two
documents are linked when the Jaccard similarity of their sets is at least ``num / den``, compared in whole numbers.

1. Documents with equal sets (by a 128-bit hash) become one node, so copies cost one row each. Nodes are numbered by a
   64-bit hash of that hash, with the first salt under which no two nodes have one number.
2. N-grams are ordered rare first: by the count of their bucket in a table of fixed size that counts all n-grams of all
   documents, then by hash. Any total order gives the same links; this one keeps frequent n-grams out of the prefixes.
3. Each node posts its first ``n - ceil(n * num / den) + 1`` n-grams with their positions. Nodes within the threshold share
   one of those. A posting is dropped when the length and positional bounds rule out every other node of its list.
4. Lists are worked off in rounds. In a leader round each node of a list is paired with the list's leader only (the node
   in most lists), so a list gives as many pairs as it has nodes. Links join components, and lists whose nodes lie in one
   component are finished: thousands of near copies never become all pairs. What is left after the leader rounds is paired
   in full, between different components and under the filters, so no link is lost.
5. Pairs are made distinct, and none is verified twice. The length and positional filters act in the join; the suffix filter parts the
   n-grams into fixed classes and sums the differences of the class sizes, a lower bound of the sets' difference. The rest is verified on
   the full sets.

The table of bucket counts (4 MB) reaches the driver and is broadcast. Full sets are made again, from the texts, for the nodes of
pairs that pass all filters, once for each node; their keys are broadcast up to ``BROADCAST_ROWS`` and joined beyond that.

Defined results: a null text or one without words has an empty set and is linked with nothing; a null key keeps its count,
is linked with nothing and has no component; rows that repeat a key are one document with several texts, whose links are
those of all its texts; an empty
table gives an empty table; other columns are not read. Texts are processed whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import map_slices, small_or_joined, staged, texts
from stratamart.llm.components import component_roots

BUCKET_BITS, BLOCKS, LANES = 20, 64, 256
CLASSES = 16
LEADER_ROUNDS = 2


def ngram_hashes(text: str, words: int) -> np.ndarray:
    """The sorted distinct hashes of a text's n-grams; A-Z are lower-cased, words end at ASCII white space only."""
    found = text.encode("utf-8").lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    width = min(words, n)
    mixed = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ h[i:n - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed * np.uint64(0xBF58476D1CE4E5B9))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def bucket_counts(df: DataFrame, text: str, words: int) -> np.ndarray:
    """How many n-grams of all documents fall into each bucket, as an array of fixed size."""
    width = (1 << BUCKET_BITS) // BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = texts(batch.column(0).slice(start, 256))
                total += np.bincount(_bucket(np.concatenate([ngram_hashes(t, words) for t in rows])), minlength=len(total))
        lane = TaskContext.get().partitionId() % LANES
        # Half as wide as they are added up: one input partition has no bucket of 2^32 n-grams.
        narrow = total.astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BLOCKS), pa.int32()), pa.array([lane] * BLOCKS, pa.int32()),
             pa.array([narrow[i * width:(i + 1) * width].tobytes() for i in range(BLOCKS)], pa.binary())],
            names=["block", "lane", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for counts in rows["counts"]:
            total += np.frombuffer(counts, np.uint32 if len(counts) == 4 * width else np.int64)
        return rows.head(1).assign(counts=[total.tobytes()])

    schema = "block int, lane int, counts binary"
    parts = df.select(text).mapInArrow(count, schema)
    sums = parts.groupBy("block", "lane").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    blocks = {r["block"]: np.frombuffer(r["counts"], np.int64) for r in sums.collect()}
    if not blocks:
        return np.zeros(1 << BUCKET_BITS, np.uint32)
    return np.minimum(np.concatenate([blocks[i] for i in range(BLOCKS)]), 0xFFFFFFFF).astype(np.uint32)


def sets_of(df: DataFrame, key: str, text: str, words: int, num: int, den: int, counts: np.ndarray) -> DataFrame:
    """key, n (set size), mark (hash of the set, null without words), prefix (rare first), classes (n-grams in each class)."""
    shared = df.sparkSession.sparkContext.broadcast(counts)

    def factory():
        order = shared.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, nodes, prefixes, classes = [], [], [], []
            for t in texts(batch.column(1)):
                h = ngram_hashes(t, words)
                n = len(h)
                sizes.append(n)
                nodes.append(xxhash.xxh3_128_digest(h.tobytes()) if n else None)
                first = h[np.lexsort((h, order[_bucket(h)]))[:n - -(-n * num // den) + 1]] if n else h
                prefixes.append(first.astype(np.int64))
                classes.append(np.bincount((h & np.uint64(CLASSES - 1)).astype(np.int64), minlength=CLASSES).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(classes, pa.list_(pa.int32()))],
                names=[key, "n", "mark", "prefix", "classes"])
        return work

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, n long, mark binary, prefix array<long>, classes array<int>"
    return map_slices(df.select(F.col(key), F.col(text)), factory, schema)


def full_sets(df: DataFrame, text: str, words: int) -> DataFrame:
    """node and grams (all hashes of its set) of each row of ``df`` (node, mark, text) whose text has that set."""

    def factory():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [(node, h) for node, mark, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)))
                    if xxhash.xxh3_128_digest((h := ngram_hashes(t, words)).tobytes()) == mark]
            return pa.RecordBatch.from_arrays(
                [pa.array([node for node, _ in made], pa.int64()), pa.array([h.astype(np.int64) for _, h in made],
                                                                             pa.list_(pa.int64()))], names=["node", "grams"])
        return work
    return map_slices(df.select("node", "mark", F.col(text)), factory, "node long, grams array<long>")


def _may_link(n1: Column, room1: Column, n2: Column, room2: Column, num: int, den: int) -> Column:
    """Length and positional filter; room is what is left of a set from the shared n-gram on."""
    return ((n1 * num <= n2 * den) & (n2 * num <= n1 * den)
            & ((num + den) * F.least(room1, room2) >= num * (n1 + n2)))


class _Join:
    """The rounds over the posting lists of one join."""

    def __init__(self, postings: DataFrame, sizes: DataFrame, fetch: Callable[[DataFrame], DataFrame], num: int, den: int):
        self.postings, self.sizes, self.fetch, self.num, self.den = postings, sizes, fetch, num, den
        self.labels: DataFrame | None = None
        self.seen: DataFrame | None = None
        self.sets: DataFrame | None = None

    def _open_lists(self) -> DataFrame:
        """The postings of lists that hold more than one component, without those that can link with nothing there."""
        rows, label = self.postings, F.col("node")
        if self.labels is not None:
            rows, label = rows.join(self.labels, "node", "left"), F.coalesce("label", "node")
        rows = rows.withColumn("label", label)
        lists = (rows.groupBy("gram").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.min("n").alias("least"))
                 .where("a != b").select("gram", "least"))
        smallest = F.greatest("least", F.ceil(F.col("n") * self.num / F.lit(self.den)))
        alive = (self.num + self.den) * F.col("room") >= self.num * (F.col("n") + smallest)
        return rows.join(lists, "gram").where(alive).select("gram", "node", "n", "room", "label")

    def leader_round(self) -> bool:
        rows = staged(self._open_lists(), "postings")
        if rows.isEmpty():
            return False
        weight = rows.groupBy("node").agg(F.count("*").alias("lists"))
        leaders = (rows.join(weight, "node").groupBy("gram")
                   .agg(F.max(F.struct("lists", "node", "n", "room", "label")).alias("l"))
                   .select("gram", F.col("l.node").alias("x"), F.col("l.n").alias("xn"), F.col("l.room").alias("xroom"),
                           F.col("l.label").alias("xlabel")))
        met = rows.join(leaders, "gram").where("node != x")
        pairs = met.where(F.col("label") != F.col("xlabel")).where(
            _may_link(F.col("n"), F.col("room"), F.col("xn"), F.col("xroom"), self.num, self.den)).select(
            F.least("x", "node").alias("x"), F.greatest("x", "node").alias("y"), F.least("label", "xlabel").alias("p"),
            F.greatest("label", "xlabel").alias("q"))
        self.postings = met.select("gram", "node", "n", "room")
        self._link(pairs)
        return True

    def last_round(self) -> None:
        rows = staged(self._open_lists(), "postings")
        if rows.isEmpty():
            return
        other = rows.select("gram", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "room", "label")])
        pairs = rows.join(other, "gram").where(F.col("node") < F.col("o_node")).where(F.col("label") != F.col("o_label")).where(
            _may_link(F.col("n"), F.col("room"), F.col("o_n"), F.col("o_room"), self.num, self.den)).select(
            F.col("node").alias("x"), F.col("o_node").alias("y"), F.least("label", "o_label").alias("p"),
            F.greatest("label", "o_label").alias("q"))
        self._link(pairs)

    def _link(self, pairs: DataFrame) -> None:
        pairs = pairs.distinct()
        if self.seen is not None:
            pairs = pairs.join(self.seen, ["x", "y"], "left_anti")
        side = lambda a: self.sizes.select(F.col("node").alias(a), F.col("n").alias(f"{a}n"), F.col("classes").alias(f"{a}c"))
        apart = F.aggregate(F.zip_with("xc", "yc", lambda a, b: F.abs(a - b)), F.lit(0), lambda s, d: s + d)
        both = F.col("xn") + F.col("yn")
        # |X and Y| = (|X| + |Y| - difference) / 2 has to reach num / (num + den) of |X| + |Y|
        pairs = pairs.join(side("x"), "x").join(side("y"), "y").where((self.num + self.den) * (both - apart) >= 2 * self.num * both)
        pairs = staged(pairs.select("x", "y", "p", "q", both.alias("both")), "pairs")
        needed = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
        if self.sets is not None:
            needed = needed.join(self.sets.select("node"), "node", "left_anti")
        made = staged(self.fetch(needed), "grams")
        self.sets = made if self.sets is None else self.sets.unionByName(made)
        grams = lambda a: self.sets.select(F.col("node").alias(a), F.col("grams").alias(f"{a}g"))
        common = F.size(F.array_intersect("xg", "yg"))
        linked = pairs.join(grams("x"), "x").join(grams("y"), "y").where((self.num + self.den) * common >= self.num * F.col("both"))
        done = pairs.select("x", "y")
        self.seen = done if self.seen is None else self.seen.unionByName(done)
        self._relabel(component_roots(linked.select(F.col("p").alias("u"), F.col("q").alias("v"))))

    def unite(self, links: DataFrame) -> None:
        """Join the components of the nodes u and v of each link."""
        if links.isEmpty():
            return
        if self.labels is not None:
            for a in ("u", "v"):
                label = self.labels.select(F.col("node").alias(a), F.col("label").alias("l"))
                links = links.join(label, a, "left").withColumn(a, F.coalesce("l", a)).drop("l")
        self._relabel(component_roots(links))

    def _relabel(self, roots: DataFrame | None) -> None:
        if roots is None:
            return
        moved = roots.select(F.col("u").alias("node"), F.col("v").alias("label"))
        if self.labels is not None:
            old = (self.labels.join(roots, self.labels["label"] == roots["u"], "left")
                   .select("node", F.coalesce("v", "label").alias("label")))
            moved = old.unionByName(moved)
        self.labels = staged(moved, "labels")


def ngram_components(df: DataFrame, words: int = 5, num: int = 80, den: int = 100, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """key, n (size of the document's set) and component (the smallest key reachable by links) of every row."""
    docs = staged(sets_of(df, key, text, words, num, den, bucket_counts(df, text, words)), "sets")
    linkable = F.col("mark").isNotNull() & F.col(key).isNotNull()
    marks, salt = docs.where(linkable).select("mark").distinct(), 0
    while not marks.groupBy(F.xxhash64(F.lit(salt), "mark")).count().where("count > 1").isEmpty():
        salt += 1
    docs = docs.withColumn("node", F.when(linkable, F.xxhash64(F.lit(salt), "mark")))
    own = docs.where(F.col("node").isNotNull())
    # The texts of one key are one document.
    several = own.groupBy(key).agg(F.min("node").alias("u"), F.max("node").alias("w")).where("u != w")
    several = staged(own.select(key, F.col("node").alias("v")).join(several.select(key, "u"), key).select("u", "v").distinct(), "one-key")
    nodes = own.groupBy("node").agg(F.min(key).alias(key), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    posted = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "gram")).repartition("gram")
    # The counts ask for all columns, so that they and the join use one and the same shuffle.
    asked = F.max("node").isNotNull() & F.max("n").isNotNull() & F.max("pos").isNotNull()
    shared = posted.groupBy("gram").agg(F.count("*").alias("m"), asked.alias("asked")).where("m > 1 and asked").select("gram")
    postings = staged(posted.join(shared, "gram").select("gram", "node", "n", (F.col("n") - F.col("pos")).alias("room")), "postings")
    listed = postings.select("node").distinct()
    chosen = own.join(listed, "node").groupBy("node").agg(
        F.min(key).alias(key), F.first("n").alias("n"), F.first("mark").alias("mark"), F.first("classes").alias("classes"))
    chosen = staged(chosen, "listed")

    def fetch(needed: DataFrame) -> DataFrame:
        """The sets of these nodes, from the text of one document of each."""
        wanted = staged(chosen.select(key, "node", "mark").join(needed, "node"), "wanted")
        return full_sets(df.select(F.col(key), F.col(text)).join(small_or_joined(wanted), key), text, words)

    join = _Join(postings, chosen.select("node", "n", "classes"), fetch, num, den)
    for _ in range(LEADER_ROUNDS):
        if not join.leader_round():
            break
    else:
        join.last_round()
    join.unite(several)
    rows = docs.select(key, "n", "node")
    if join.labels is not None:
        rows = rows.join(join.labels, "node", "left").select(key, "n", F.coalesce("label", "node").alias("label"))
    else:
        rows = rows.withColumnRenamed("node", "label")
    least = rows.where("label is not null").groupBy("label").agg(F.min(key).alias("component"))
    return rows.join(least, "label", "left").select(key, "n", F.coalesce("component", key).alias("component"))
