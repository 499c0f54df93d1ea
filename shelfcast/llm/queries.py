"""One query per text operator, with its production parameters, and SQL twins where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import (
    byte_bpe,
    chat,
    decontamination,
    language_id,
    prefix_trie,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    spelling,
    toxicity,
    twins,
    warc,
)
from shelfcast.llm.shared import map_texts, shared_folder, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard(table(spark, d, "documents"))


def op2_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "removed_words",
    )


def op3_chat_format(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    formatted = chat.format_conversations(rows.unionByName(hard))

    def start():
        return lambda texts, spans: [chat.digests(t, s) for t, s in zip(texts, spans)]

    fields = [
        T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
    read = map_texts(formatted, start, fields, reads=("formatted", "loss_spans"))
    return read.drop("formatted", "loss_spans")


def op4_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"), shingle_words=3, max_bits=2)


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, d, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "offending")


def op6_decontamination(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    marked = decontamination.decontaminate(docs, table(spark, d, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op7_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    digests = ("n_tokens", "ids_sha256", "decoded_sha256")
    coded = byte_bpe.encode_documents(docs, VOCABULARY, public_tokenizers.PATTERN, digests)
    return coded.select("doc_id", *digests)


def op8_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return language_id.language_id(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality_classifier.quality(table(spark, d, "documents"), table(spark, d, "labels"))


def op10_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, d, "documents").select("doc_id", "text"))
    base = secret_scan.spelled("secrets", secret_scan.BASE)
    return found.select(
        "doc_id",
        *[secret_scan.count_kind("secrets", k).alias(f"n_{k}") for k in secret_scan.BASE],
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.spelled("secrets").alias("spans"),
    )


def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    """Each conversation takes its first turns from the first of its group of five."""
    donor = F.col("conv_id") - F.col("conv_id") % 5
    taken = F.crc32(F.col("conv_id").cast("string")) % 9
    return prefix_trie.prefix_trie(table(spark, d, "conversations"), donor, taken, most_taken=8)


def op12_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(table(spark, d, "pages"), folder)
    return warc.read_archive(spark, folder)


def op13_spelling(spark: SparkSession, d: str) -> DataFrame:
    """Words of seven code points or more, one in 31 of their occurrences with a letter left out."""
    runs = spelling.runs(table(spark, d, "documents")).filter("length(run) >= 7")
    said = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    spelt = runs.select("run", F.crc32(said).alias("h")).selectExpr(
        """CASE WHEN h % 31 = 0
        THEN concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))
        ELSE run END AS word"""
    )
    words = spelt.filter("length(word) >= 7").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return spelling.group_variants(words.filter("n >= 2"))


QUALITY_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS body,
    string_split(coalesce(text, ''), chr(10)) AS raw,
    list_transform(string_split(translate(coalesce(text, ''),
      chr(9) || chr(11) || chr(12) || chr(13), '    '), chr(10)),
      lambda x: list_filter(string_split(x, ' '), lambda w: w <> '')) AS said
  FROM documents
), w AS (
  SELECT *, flatten(said) AS words,
    list_transform(list_filter(range(1, len(raw) + 1), lambda i: len(said[i]) > 0), lambda i: raw[i])
      AS full_lines
  FROM d
), starts AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), again AS (
  SELECT doc_id, i FROM starts QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), m AS (
  SELECT doc_id, source, len(words) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
    len(full_lines) - len(list_distinct(full_lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words) AS base_failed
  FROM w LEFT JOIN covered USING (doc_id)
), line AS (
  SELECT doc_id, coalesce(source, '-') AS host, body, len(ws) AS n,
    translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS said
  FROM (SELECT doc_id, source, body, unnest(said) AS ws FROM w) WHERE len(ws) > 0
), shared AS (
  SELECT host, said FROM line GROUP BY host, said HAVING count(DISTINCT body) >= 6
), places AS (
  SELECT doc_id, host, said, sum(n) AS n, any_value(n_words) AS n_words, any_value(NOT base_failed) AS good
  FROM line JOIN shared USING (host, said) JOIN m USING (doc_id) GROUP BY doc_id, host, said
), first_pass AS (
  SELECT doc_id, sum(CASE WHEN doc_id <> keeper THEN n ELSE 0 END) <= 0.3 * any_value(n_words) AS stays
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY host, said) AS keeper FROM places WHERE good)
  GROUP BY doc_id
), once AS (
  SELECT p.*, coalesce(stays, false) AS stays,
    bool_or(coalesce(stays, false)) OVER (PARTITION BY host, said) AS held
  FROM places p LEFT JOIN first_pass USING (doc_id)
), able AS (
  SELECT doc_id FROM once WHERE good AND NOT stays GROUP BY doc_id
  HAVING sum(CASE WHEN held THEN n ELSE 0 END) <= 0.3 * any_value(n_words)
), back AS (
  SELECT DISTINCT min(doc_id) AS doc_id FROM once JOIN able USING (doc_id)
  WHERE NOT held GROUP BY host, said
), last AS (
  SELECT o.* EXCLUDE (stays), stays OR b.doc_id IS NOT NULL AS stays
  FROM once o LEFT JOIN back b USING (doc_id)
), kept_lines AS (
  SELECT *, min(CASE WHEN stays THEN doc_id END) OVER (PARTITION BY host, said) AS keeper FROM last
), gone AS (
  SELECT doc_id, bool_or(stays) AS stays, sum(CASE WHEN doc_id <> keeper THEN n ELSE 0 END) AS removed
  FROM kept_lines GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed_words,
  NOT base_failed AND coalesce(stays, true) AS kept
FROM m LEFT JOIN gone USING (doc_id)
"""

# A turn has 15 characters around role and text; a text that would not read back as it is has a
# backslash before each of its marks.
CHAT_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)
), marked AS (
  SELECT *,
    regexp_matches(text, '\\(### |: |</turn>|\\)') OR contains(text, ' </turn>' || chr(10)) AS hard,
    (length(text) - length(replace(text, '### ', ''))) // 4
      + (length(text) - length(replace(text, ': ', ''))) // 2
      + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS marks
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(role) + length(text) + CASE WHEN hard THEN marks ELSE 0 END) AS BIGINT)
    AS formatted_chars
FROM marked GROUP BY conv_id
"""

LEAKS_SQL = r"""
WITH said AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), asked AS (
  SELECT item_id, words, least(10, len(words)) AS size FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark)
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM asked WHERE size > 0)
), doc_windows AS (
  SELECT doc_id, size, i, array_to_string(list_slice(words, i, i + size - 1), ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
    FROM said, (SELECT DISTINCT size FROM item_windows))
), hits AS (
  SELECT d.doc_id, d.i, d.size, coalesce(CAST(item_id AS VARCHAR), '') AS item
  FROM doc_windows d JOIN item_windows w ON d.size = w.size AND d.win = w.win
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM said LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_quality_rules": op2_quality_rules,
    "op3_chat_format": op3_chat_format,
    "op4_simhash": op4_simhash,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_language_id": op8_language_id,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_secret_scan": op10_secret_scan,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_warc": op12_warc,
    "op13_spelling": op13_spelling,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_rules": QUALITY_SQL,
        "op3_chat_format": CHAT_SQL,
        "op6_decontamination": LEAKS_SQL,
        "op11_prefix_trie": twins.TRIE_SQL,
        "op12_warc": twins.ARCHIVE_SQL,
        "op13_spelling": twins.SPELLING_SQL,
    }
