"""Near-duplicate lines within one edit, by deletion neighbourhoods.

Lines are compared without the white space around them; blank lines always stay. A line goes if an earlier line (by key, then
line number) is equal or, from ``min_chars`` characters on, at most one insertion, deletion or substitution away: one edit
makes another word of a short line. Of equal lines the earliest stays.

Equal lines are one row from the first aggregate on. A line of 4g to 4g + 4 characters that is within one edit of another
such line shares its first or its last 2g characters with it, so only lines that share such a part go further; what is left
is filtered in the same way by all but one of eight parts. Of the few lines left all variants with one character deleted are
emitted as hashed keys. Lines that are equal without the character at the same place, and lines that equal another line
after one deletion, meet in a group. Distinct lines of a group differ at one place, so a group has at most as many lines as
there are characters (times the places), whatever the number of rows. Each line is paired with the earliest line of its
group only, since that decides whether it goes, and the edit distance of each pair is verified with the texts.

Built-in functions only. Tables whose size was counted are broadcast up to ``BROADCAST_ROWS`` rows and joined by shuffle
beyond.

Defined results: a null text has no lines and is returned as null; a null key counts as the smallest; equal rows (key and
text) stand or fall together, as copies of one document; an empty table gives an empty table; other columns come back
unchanged. Lines of any length are handled whole, one variant in memory at a time; the time for a line that reaches the last
step grows with the square of its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import blob_hash, small_or_joined, staged

MIN_CHARS = 20
PARTS = 8
AROUND = " \t\x0b\x0c\r"


def _both(names: tuple[str, str], *columns) -> list[Column]:
    return [c.alias(n) for c, n in zip(blob_hash(*columns), names)]


def occurrences(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each line that is not blank: born = (key, text hash, line number), line, h1, h2."""
    lines = df.select(F.col(key).alias("k"), F.xxhash64(text).alias("t1"),
                      F.posexplode(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(AROUND)))).alias("pos", "line"))
    return (lines.where("line != ''")
            .select(F.struct("k", "t1", "pos").alias("born"), "line", *_both(("h1", "h2"), "line")))


def half_keys(line: Column) -> Column:
    """Keys of which two lines within one edit share one: the first and the last 2g characters of lengths 4g to 4g + 4."""
    size = F.char_length(line)
    group = F.floor(size / 4).cast("int")

    def keys(g: Column) -> list[Column]:
        return [F.xxhash64(F.lit(0), g, F.substring(line, F.lit(1), 2 * g)),
                F.xxhash64(F.lit(1), g, F.substring(line, size - 2 * g + 1, 2 * g))]
    return F.when(size % 4 == 0, F.array(*keys(group), *keys(group - 1))).otherwise(F.array(*keys(group)))


def part_keys(line: Column) -> Column:
    """Sharper keys: all but one of ``PARTS`` parts, for this length (n) and for one less."""
    size = F.char_length(line)
    keys = []
    for less in (0, 1):
        n = size - less
        for part in range(PARTS):
            start, end = (F.floor(n * x / PARTS).cast("int") for x in (part, part + 1))
            keys.append(F.xxhash64(F.lit(part), n, F.substring(line, F.lit(1), start), F.substring(line, size - (n - end) + 1, n - end)))
    return F.array(*keys)


def sharing(lines: DataFrame, keys: str) -> DataFrame:
    """h1 of the lines (distinct; h1 and an array of keys) that share a key with another line."""
    keyed = lines.select("h1", F.explode(keys).alias("key"))
    groups = staged(keyed.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b"), F.count("*").alias("n")).where("n > 1"), "shared-keys")
    ends = groups.select(F.explode(F.array("a", "b")).alias("h1"))
    inner = keyed.join(small_or_joined(groups.where("n > 2").select("key")), "key", "left_semi").select("h1")
    return ends.unionByName(inner).distinct()


def late_lines(lines: DataFrame, found: DataFrame) -> DataFrame:
    """h1, h2 of the distinct lines (h1, h2, born, halves) that have an earlier line within one edit.

    ``found`` has their texts: only the lines that share a half with another are read from it.
    """
    close = lines.join(sharing(lines, "halves"), "h1", "left_semi").select("born")
    close = small_or_joined(staged(close, "close-lines"))
    near = staged(found.join(close, "born").dropDuplicates(["h1", "h2"]).withColumn("parts", part_keys(F.col("line"))), "near-lines")
    near = staged(near.join(sharing(near, "parts"), "h1", "left_semi").drop("parts"), "near-lines")
    # One row for each place, then one variant at a time: a line's variants together are as long as its length squared.
    places = near.select(F.struct("born", "h1", "h2").alias("who"), "line", F.explode(F.sequence(F.lit(0), F.char_length("line"))).alias("tag"))
    # Place 0 is the whole line. A column of its own, so that both hashes use one string.
    rest = F.concat(F.substring(F.col("line"), F.lit(1), F.col("tag") - 1), F.expr("substring(line, tag + 1)"))
    variants = places.select("who", "tag", rest.alias("rest")).select("who", "tag", *_both(("v1", "v2"), "rest"))
    same, place = Window.partitionBy("v1", "v2"), Window.partitionBy("v1", "v2", "tag")
    whole = F.col("tag") == 0
    met = variants.select("who", F.array(
        F.when(~whole, F.min("who").over(place)),
        F.when(whole, F.min(F.when(~whole, F.col("who"))).over(same)).otherwise(F.min(F.when(whole, F.col("who"))).over(same))).alias("met"))
    pairs = (met.select("who", F.explode("met").alias("first")).where("first.born < who.born")
             .select("who.h1", "who.h2", F.col("first.h1").alias("f1"), F.col("first.h2").alias("f2")).distinct())
    mine, theirs = near.select("h1", "h2", "line"), near.select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.col("line").alias("other"))
    verified = (pairs.join(mine, ["h1", "h2"]).join(theirs, ["f1", "f2"])
                .where(F.levenshtein("line", "other", 1).between(0, 1)))
    return verified.select("h1", "h2").distinct()


def duplicate_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """k, t1 (key and hash of the text) and gone, the numbers of the lines to remove, for documents that lose lines."""
    found = occurrences(df, key, text)
    # Short lines have no keys of parts, so they meet no others than their copies.
    halves = F.when(F.char_length("line") >= min_chars, half_keys(F.col("line")))
    held = staged(found.select("born", "h1", "h2", halves.alias("halves")), "line-hashes")
    lines = staged(held.groupBy("h1", "h2").agg(F.min("born").alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves")), "lines")
    late = late_lines(lines.select("h1", "h2", F.col("first").alias("born"), "halves"), found).withColumn("late", F.lit(True))
    judged = staged(lines.select("h1", "h2", "first", "n").join(late, ["h1", "h2"], "left").where("n > 1 or late"), "judged-lines")
    gone = held.select("born", "h1", "h2").join(small_or_joined(judged), ["h1", "h2"]).where("late or born != first")
    return gone.groupBy("born.k", "born.t1").agg(F.array_distinct(F.collect_list("born.pos")).alias("gone"))


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """The input with its text reduced to the lines that stay, and n_lines and n_removed under the names of ``counts``.

    Columns of the input with these names are replaced.
    """
    gone = duplicate_lines(df, key, text, min_chars).toDF("__k", "__t1", "__gone").hint("shuffle_hash")
    rows = df.withColumn("__h1", F.xxhash64(text))
    rows = rows.join(gone, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__h1") == F.col("__t1")), "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("__gone", i)), "\n")
    n_lines, n_removed = counts
    return (rows.withColumn(n_lines, F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"))
            .withColumn(n_removed, F.when(F.col("__gone").isNull(), F.lit(0)).otherwise(F.size("__gone")).cast("long"))
            .withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept))
            .drop("__k", "__t1", "__h1", "__gone"))
