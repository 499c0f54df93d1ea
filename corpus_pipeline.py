"""From raw documents to token ids: five stages, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import byte_bpe, decontamination, quality_rules, secret_scan, simhash
from shelfcast.llm.shared import stored, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _with_text(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``docs`` with another text, its length renewed where the text changed."""
    changed = ~F.col(text).eqNullSafe(F.col("text"))
    renewed = {"n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return docs.withColumns(renewed | {"text": F.col(text)}).select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; kept ones lose the lines that their host repeats."""
    judged = quality_rules.quality_rules(docs)
    return _with_text(judged.filter("kept"), "clean_text", docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies stays."""
    return simhash.deduplicate(docs, shingle_words=3, max_bits=2)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    marked = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return marked.filter("NOT contaminated").select(*docs.columns)


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark with their kind."""
    return _with_text(secret_scan.scan_secrets(docs), "redacted", docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, and digests of the ids and of the text decoded from them."""
    coded = byte_bpe.encode_documents(
        docs.select("doc_id", "text"), VOCABULARY, public_tokenizers.PATTERN
    )
    return coded.drop("text")


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_free),
    ("secrets", secret_free),
    ("byte_bpe", encoded),
]

#: Fingerprints, token ids and patterns with checksums are not SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written out and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
