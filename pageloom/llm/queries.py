"""The registered queries of this subpackage, each over its whole table, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pageloom.llm import align, binary, bpe, chat, decontaminate, jaccard, langid, licenses, quality, resample, rollups, substrings, urlfilter
from pageloom.llm.base import scratch, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


# The stop words and percentages are written out here so that the SQL does not follow a change of the rules.
OP2_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM texts),
counts AS (
  SELECT rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(replace(text, '!', '')) AS n_bangs,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         len(list_filter(ws, lambda x: lower(x) IN (
           'a','an','and','are','as','at','be','by','for','from','has','he','in','is','it','its','of','on','or','that','the',
           'this','to','was','were','will','with','you','das','dem','den','der','des','die','ein','eine','er','es','für','ich',
           'im','ist','mit','nicht','sie','sich','und','von','zu','auf','als','auch','au','aux','avec','ce','ces','dans','de',
           'du','elle','en','est','et','il','la','le','les','ne','pas','pour','que','qui','sur','un','une','al','como','con',
           'del','el','las','lo','los','más','no','para','por','se','su','una','y','o'))) AS n_stop
  FROM words),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS w
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM words WHERE len(ws) >= 5)),
repeated AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, w) > 1),
covered AS (
  SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM repeated) GROUP BY rid),
judged AS (
  SELECT c.*, coalesce(n, 0)::BIGINT AS n_repeat_words,
         n_words < 10 OR 100 * coalesce(n, 0) > 20 * n_words AS base_failed
  FROM counts c LEFT JOIN covered USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * word_chars BETWEEN 150 * n_words AND 2000 * n_words AND 100 * n_symbols <= 40 * n_words
       AND 100 * n_bangs <= 40 * n_words AND (n_words < 60 OR 100 * n_stop >= 2 * n_words)
       AND 100 * n_dup_lines <= 50 * n_lines AS kept
FROM judged
"""


@query("op2_quality_rules", OP2_SQL)
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_url_filter")
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return urlfilter.url_filter(pages, urlfilter.train(spark)).select("page_id", "host", "path", "rule", "verdict", "score")


@query("op8_language_id")
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query("op5_license_scan")
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents")).drop("spans")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """`ids` and `decoded` of the operator, as digests."""
    encoded = bpe.encode(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op6_token_files")
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "token-files")
    binary.write_tokens(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return binary.read_digests(spark, path)


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_ngram_jaccard")
def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_copies(table(spark, folder, "documents")).select("doc_id", "class_id", "copies", "n_links")


OP7_SQL = r"""
WITH kept AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text FROM documents
  QUALIFY row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) = 1),
own AS (
  SELECT source, lang, array_to_string(list_distinct(string_split(text, chr(10))), chr(10)) AS text FROM kept),
counts AS (
  SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n FROM own
  UNION ALL
  SELECT source, lang, 'runs-1', len(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) FROM own)
SELECT source, lang, version, count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens FROM counts GROUP BY ALL
"""


@query("op7_token_counts", OP7_SQL)
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus comes in three batches (all documents, copies go, repeated lines go); each is sent twice and counts once."""
    counts = written(rollups.counted(table(spark, folder, "documents")), "counts")
    rollup = rollups.TokenRollup(spark, scratch(spark, "rollup"))
    for number, changes in enumerate(rollups.corpus_batches(counts), 1):
        rollup.apply(changes, number)
        rollup.apply(changes, number)
    return rollup.totals()


OP10_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '<\|') AS text FROM conversations),
people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker NOT IN ('system', 'unknown')),
rendered AS (
  SELECT t.conv_id, perspective, turn, speaker,
         CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = perspective THEN '<|assistant|>'
              ELSE '<|user name=' || replace(replace(speaker, '<|', '<\|'), '|>', '|\>') || '|>' END AS header, text
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
segments AS (
  SELECT *, header || chr(10) || text || '<|end|>' || chr(10) AS segment FROM rendered),
summed AS (
  SELECT *, sum(length(segment)) OVER (
    PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, segment ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
  FROM segments)
SELECT conv_id, perspective, turn, segment, stop - length(segment) AS start, stop,
       CASE WHEN speaker = perspective THEN stop - length(segment) + length(header) + 1 END AS mask_start,
       CASE WHEN speaker = perspective THEN stop - 1 END AS mask_stop
FROM summed
"""


@query("op10_chat_rotation", OP10_SQL)
def op10_chat_rotation(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rotate(table(spark, folder, "conversations"))


OP12_SQL = r"""
WITH bytes AS (
  SELECT i, list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) AS c
  FROM range(256) AS t(i)),
crc AS (SELECT list(c ORDER BY i) AS t FROM bytes),
docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
found AS (
  SELECT rid, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM docs),
wanted AS (
  SELECT unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
vocabulary AS (
  SELECT w, xor(4294967295, list_reduce(
    list_transform(range(length(hex(encode(w))) // 2), lambda k: ('0x' || substr(hex(encode(w)), 2 * k + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 10000 AS bucket
  FROM (SELECT w FROM found UNION SELECT w FROM wanted), crc),
own AS (SELECT bucket, count(*) AS s FROM found JOIN vocabulary USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM wanted JOIN vocabulary USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0)::DOUBLE FROM own) AS ss, (SELECT coalesce(sum(t), 0)::DOUBLE FROM target) AS tt),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS gain
  FROM own LEFT JOIN target USING (bucket), totals),
weights AS (
  SELECT rid, count(*) AS n, sum(gain)::BIGINT AS weight FROM found JOIN vocabulary USING (w) JOIN gains USING (bucket) GROUP BY rid),
scored AS (
  SELECT rid, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)
                                                    / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (rid)),
placed AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (rid)
"""


@query("op12_importance_resampling", OP12_SQL)
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.linked(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_substring_dedup")
def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
