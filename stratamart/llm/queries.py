"""The corpus operators as queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.bm25_search import bm25_topk
from stratamart.llm.byte_codec import decode_documents, encode_documents
from stratamart.llm.chat_format import chat_examples, loss_text, parsed_turns
from stratamart.llm.fill_middle import fill_middle, restored
from stratamart.llm.html_extract import extract_pages
from stratamart.llm.line_dedup import MIN_CHARS, dedup_lines
from stratamart.llm.ngram_join import ngram_components
from stratamart.llm.packing import pack_documents
from stratamart.llm.periodic_runs import periodic_runs
from stratamart.llm.piece_codec import encode_digests
from stratamart.llm.quality_rules import quality_rules
from stratamart.llm.sharding import shard_documents
from stratamart.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@_query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bm25_topk(docs, docs.where(F.col("doc_id") % 100 == 0)).withColumnRenamed("query", "query_id")


ORACLES["op5_topk_search"] = """
WITH w AS (SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+') if x <> ''] AS words FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM w) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
t AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM w),
hit AS (
  SELECT q.doc_id AS query_id, d.doc_id,
         round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * len(words) / mean))), 6) AS score
  FROM tf q JOIN tf d USING (term) JOIN df USING (term) JOIN w ON w.doc_id = d.doc_id CROSS JOIN t
  WHERE q.doc_id % 100 = 0 GROUP BY ALL)
SELECT query_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM hit) WHERE rank <= 10"""


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "tokens")


@_query
def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_template", "n_slots")


@_query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_components(table(spark, sf_dir, "documents"), words=4, num=85, den=100)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


#: Sets by their text, all pairs with a common n-gram, and reachability by a recursive query.
def component_sql(words: int, num: int, den: int, docs: str = "documents") -> str:
    return f"""
w AS (SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+') if x <> ''] AS words FROM {docs}),
s AS (SELECT DISTINCT doc_id, gram FROM (
        SELECT doc_id, array_to_string(words, ' ') AS gram FROM w WHERE len(words) BETWEEN 1 AND {words - 1}
        UNION ALL SELECT doc_id, array_to_string(words[i:i + {words - 1}], ' ') FROM (
          SELECT doc_id, words, unnest(generate_series(1, len(words) - {words - 1})) AS i FROM w))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING {den} * count(*) >= {num} * (na.n + nb.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)"""


ORACLES["op3_ngram_join"] = f"""
WITH RECURSIVE {component_sql(4, 85, 100)}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN component c USING (doc_id)"""


@_query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words")


# Lines by their own text instead of hashes; repeated windows through the positions they cover.
ORACLES["op4_quality_rules"] = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, [x for x in string_split_regex(text, '[ \\t-\\r]+') if x <> ''] AS words, text FROM d),
g AS (SELECT doc_id, i, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS gram
      FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, generate_series(0, 4) AS s(k) GROUP BY doc_id),
raw AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT *, len([x for x in string_split_regex(line, '[ \\t-\\r]+') if x <> '']) AS n_words,
                 regexp_replace(trim(regexp_replace(lower(line), '[ \\t-\\r]+', ' ', 'g')), '[0-9]', '0', 'g') AS norm
          FROM raw WHERE regexp_matches(line, '[^ \\t-\\r]')),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines
        FROM (SELECT doc_id, line, count(*) AS n FROM lines GROUP BY ALL) GROUP BY doc_id),
sizes AS (SELECT host, count(DISTINCT text) AS size FROM d GROUP BY host),
freq AS (SELECT host, norm, count(DISTINCT text) AS docs, min(doc_id) AS first FROM lines GROUP BY ALL),
gone AS (SELECT l.doc_id, sum(l.n_words)::BIGINT AS n_removed_words
         FROM lines l JOIN freq f USING (host, norm) JOIN sizes s USING (host)
         WHERE docs > 20 AND docs > 0.01 * size AND l.doc_id <> f.first GROUP BY l.doc_id),
base AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in words]), 0)::BIGINT AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_removed_words, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_removed_words <= 0.8 * n_words AS kept
FROM base"""


@_query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_removed", F.char_length(text).cast("long").alias("n_chars"),
                       F.sha2(text, 256).alias("text_sha256"))


# Independent of the operator: births of equal lines by a window, near pairs by their shared halves and full distance.
ORACLES["op9_line_dedup"] = f"""
WITH raw AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS raw
  FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM raw),
born AS (
  SELECT line, doc_id, pos, row_number() OVER (ORDER BY doc_id, pos) AS seq FROM (
    SELECT line, doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS rn
    FROM lines WHERE line <> '') WHERE rn = 1),
halves AS (
  SELECT line, seq, length(line) - less AS n, side,
         CASE WHEN side = 0 THEN line[1:(length(line) - less) // 2]
              ELSE line[length(line) - (length(line) - less - (length(line) - less) // 2) + 1:] END AS half
  FROM born, (VALUES (0), (1)) AS l(less), (VALUES (0), (1)) AS s(side) WHERE length(line) >= {MIN_CHARS}),
late AS (
  SELECT DISTINCT b.line FROM halves a JOIN halves b USING (n, side, half)
  WHERE a.seq < b.seq AND levenshtein(a.line, b.line) <= 1),
judged AS (
  SELECT l.doc_id, l.pos, l.raw,
         l.line <> '' AND (b.doc_id IS NULL OR l.line IN (SELECT line FROM late)) AS gone
  FROM lines l LEFT JOIN born b ON l.line = b.line AND l.doc_id = b.doc_id AND l.pos = b.pos),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       length(coalesce(k.text, ''))::BIGINT AS n_chars, sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)"""


@_query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = spark.range(1, 3).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 1, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    read = chat_examples(turns).select(
        "conv_id", "lone", "example", F.col("n_turns").cast("long"), "complete", F.char_length("text").cast("long").alias("chars"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"),
        F.when(F.col("complete"), parsed_turns(F.col("text"))).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    by_conv = read.groupBy("conv_id", "lone").agg(
        F.max(F.when(F.col("complete"), F.col("n_turns"))).alias("n_turns"),
        F.max(F.when(F.col("complete"), F.sha2(said, 256))).alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    return by_conv.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                          F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


ORACLES["op10_chat_format"] = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone FROM conversations
  UNION ALL SELECT -7, n, r, '</s>[INST] ok [/INST]', NULL FROM (VALUES (1, 'user'), (2, 'assistant')) AS v(n, r)),
f AS (
  SELECT *, 8 + length(role) + 1 + 8
            + length(text) + 4 * (length(text) - length(replace(text, '&', ''))) + 3 * (length(text) - length(replace(text, '<', '')))
            AS made,
         row_number() OVER (PARTITION BY conv_id, lone ORDER BY turn DESC, role DESC, text DESC) AS back
  FROM t),
c AS (
  SELECT *, sum(made) OVER (PARTITION BY conv_id, lone ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS so_far FROM f)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(so_far) FILTER (role = 'assistant' OR back = 1)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id, lone"""


def _with_period(df: DataFrame) -> DataFrame:
    """One text in ten made periodic from some word on, as a hash of its id says."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")
    return df.select("doc_id", F.when(h % 10 == 0, F.when(n > 0, made)).otherwise(F.col("text")).alias("text"))


@_query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_period(table(spark, sf_dir, "documents")))

    def stronger(x, y):
        more, less = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(more > less, -1).when(more < less, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1)
                .when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))

    best = F.get(F.array_sort("runs", stronger), F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), listed.alias("listed"), best.alias("best"), "collapsed").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


# Independent of the operator: equal words at a distance, joined within a text, and their streaks.
ORACLES["op11_periodic_runs"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_prepend(4294967295, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
                                                           for c in string_split(doc_id::VARCHAR, '')])),
                         lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                                             ELSE xor(crc >> 1, CASE WHEN crc & 1 = 1 THEN 3988292384 ELSE 0 END) END),
             4294967295) AS h
  FROM documents),
c AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM d),
e AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM c),
t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                             THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] for i in range(n)] ELSE w END AS w FROM e),
pos AS (SELECT doc_id, n, i, w[i + 1] AS word FROM (SELECT *, unnest(range(n)) AS i FROM t)),
alike AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM pos x JOIN pos y
          ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
streak AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length
           FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM alike)
           GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
run AS (SELECT doc_id, start, length, min(q) AS period FROM streak GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS k,
                               count(*) OVER (PARTITION BY doc_id) AS n_runs FROM run) WHERE k = 1),
listed AS (SELECT doc_id, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
           FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM t LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@_query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle(table(spark, sf_dir, "documents"), seed=7)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLES["op12_fill_middle"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         [('0x' || sha256('7:' || doc_id)[1 + 8 * i:8 + 8 * i])::BIGINT for i in range(4)] AS h FROM documents),
c AS (SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                  WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
             array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p"""


@_query
def op13_byte_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode_documents(table(spark, sf_dir, "documents"), path, pattern=public_tokenizers.PATTERN)
    digests = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                             F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids")
    return decode_documents(digests, path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
