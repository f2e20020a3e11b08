"""Quality rules: per-document counts, and boilerplate lines found across the documents of a host.

Each line is normalised (lower case, digits as 0, single spaces) and hashed. For each host, a line's frequency is the
number of distinct documents (texts) that hold it; exact copies of one text count once. A line above both limits - an
absolute number of documents and a share of the host's documents - is boilerplate and is removed, except from the earliest document that holds it, so that no
content leaves a corpus altogether. A document that loses more than ``max_removed`` of its words is depleted and rejected.

All counts cover all documents. Frequencies are aggregated by (host, line, text) before (host, line), so a line that a
third of all rows hold is combined before it moves.

Defined results: a null text has no words and fails the base rules; a null host is a host of its own; a null key never is
the earliest; repeated rows are judged alike; an empty table gives an empty table; other columns are not read. Texts are
processed whole.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import map_slices, staged, texts

SYMBOLS = "#*$%&|<>"
WINDOW = 5
_DIGITS = re.compile(rb"[0-9]")
_LINES = "array<struct<h1:long,h2:long,words:long,line:int>>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than ASCII white space; bytes.split parts exactly at 0x20 and 0x09 to 0x0D."""
    return text.encode("utf-8").split()


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    times, covered, reach = Counter(windows), 0, 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + WINDOW - max(at, reach)
            reach = at + WINDOW
    return covered


def _hashes(data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(data)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def counts_of(text: str) -> tuple[tuple[int, int, int, int, int], list[dict]]:
    """The five base counts, and one entry for each line that has a word."""
    words = words_of(text)
    seen, repeats, lines = set(), 0, []
    for number, line in enumerate(text.split("\n")):
        parts = line.encode("utf-8").split()
        if not parts:
            continue
        repeats += line in seen
        seen.add(line)
        h1, h2 = _hashes(_DIGITS.sub(b"0", b" ".join(line.lower().encode("utf-8", "replace").split())))
        lines.append({"h1": h1, "h2": h2, "words": len(parts), "line": number})
    chars = len(text) - sum(map(text.count, "\t\n\v\f\r "))
    return (len(words), chars, sum(map(text.count, SYMBOLS)), repeats, repeated_words(words)), lines


def measured(df: DataFrame, key: str, text: str, host: str, carry: list[str]) -> DataFrame:
    """Counts and line hashes of each row: row, k, host, t1, t2 (the text's hash), the counts, lines, and carried columns.

    ``row`` numbers the rows of this one run; store the result before using it twice. Carried columns are named c_0, c_1...
    """
    extra = [f"c_{i}" for i in range(len(carry))]
    names = ["row", "k", "host", "t1", "t2", *COUNTS, "lines", *extra]

    def factory():
        task = TaskContext.get()
        row = (task.partitionId() if task else 0) << 40

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal row
            rows = texts(batch.column(1))
            marks = [_hashes(t.encode("utf-8")) for t in rows]
            found = [counts_of(t) for t in rows]
            numbers = range(row, row + len(rows))
            row += len(rows)
            arrays = [pa.array(numbers, pa.int64()), batch.column(0), batch.column(2),
                      *(pa.array([m[i] for m in marks], pa.int64()) for i in (0, 1)),
                      *(pa.array([c[i] for c, _ in found], pa.int64()) for i in range(len(COUNTS))),
                      pa.array([lines for _, lines in found], pa.list_(pa.struct(
                          [("h1", pa.int64()), ("h2", pa.int64()), ("words", pa.int64()), ("line", pa.int32())])))]
            return pa.RecordBatch.from_arrays(arrays + batch.columns[3:], names=names)
        return work

    schema = (f"row long, k {df.schema[key].dataType.simpleString()}, host string, t1 long, t2 long, "
              + ", ".join(f"{c} long" for c in COUNTS) + f", lines {_LINES}"
              + "".join(f", {e} {df.schema[c].dataType.simpleString()}" for e, c in zip(extra, carry)))
    used = [F.col(key).alias("k"), F.col(text).alias("t"), F.col(host).cast("string").alias("h")]
    return map_slices(df.select(*used, *[F.col(c).alias(e) for e, c in zip(extra, carry)]), factory, schema)


def frequent_lines(rows: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """host, h1, h2 and the earliest key of the lines above both limits."""
    held = (rows.select("host", "t1", "t2", "k", F.explode("lines").alias("l"))
            .groupBy("host", "l.h1", "l.h2", "t1", "t2").agg(F.min("k").alias("k")))
    lines = held.groupBy("host", "h1", "h2").agg(F.count("*").alias("docs"), F.min("k").alias("first"))
    sizes = (rows.groupBy("host", "t1", "t2").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("size"))
             .withColumnRenamed("host", "of"))
    return (lines.where(F.col("docs") > max_docs).join(sizes, F.col("host").eqNullSafe(F.col("of")))
            .where(F.col("docs") > max_share * F.col("size")).select("host", "h1", "h2", "first"))


def quality_rules(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", min_words: int = 10,
                  max_repeat_percent: int = 20, max_docs: int = 20, max_share: float = 0.01,
                  max_removed: float = 0.8) -> DataFrame:
    """One row for each input row: key, the counts, n_removed_words, base_failed, kept."""
    return _judged(df, key, text, host, min_words, max_repeat_percent, max_docs, max_share, max_removed, []).select(
        F.col("k").alias(key), *COUNTS, "n_removed_words", "base_failed", "kept")


def quality_filter(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", min_words: int = 10,
                   max_repeat_percent: int = 20, max_docs: int = 20, max_share: float = 0.01,
                   max_removed: float = 0.8) -> DataFrame:
    """The rows that are kept, with their columns; their texts without the boilerplate lines."""
    rows = _judged(df, key, text, host, min_words, max_repeat_percent, max_docs, max_share, max_removed, df.columns)
    body = F.col(f"c_{df.columns.index(text)}")
    lines = F.filter(F.split(body, "\n", -1), lambda x, i: ~F.array_contains("gone", i))
    cleaned = F.when(F.col("gone").isNull(), body).otherwise(F.array_join(lines, "\n"))
    return rows.where("kept").select(*[(cleaned if c == text else F.col(f"c_{i}")).alias(c) for i, c in enumerate(df.columns)])


def _judged(df: DataFrame, key: str, text: str, host: str, min_words: int, max_repeat_percent: int, max_docs: int,
            max_share: float, max_removed: float, carry: list[str]) -> DataFrame:
    rows = staged(measured(df, key, text, host, carry), "quality")
    frequent = frequent_lines(rows, max_docs, max_share).withColumnRenamed("host", "of")
    held = rows.select("row", "k", "host", F.explode("lines").alias("l")).select("row", "k", "host", "l.*")
    removed = (held.join(frequent, ["h1", "h2"]).where(F.col("host").eqNullSafe(F.col("of")))
               .where(~F.col("k").eqNullSafe(F.col("first")))
               .groupBy("row").agg(F.sum("words").alias("n_removed_words"), *[F.collect_list("line").alias("gone")] * bool(carry)))
    n = F.col("n_words")
    failed = (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n)
    return (rows.drop("lines", "t1", "t2").join(removed, "row", "left")
            .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("n_removed_words") <= max_removed * n)))
