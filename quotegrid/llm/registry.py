"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.llm import (
    language,
    lines,
    mixing,
    neardup,
    pieces,
    quality,
    repair,
    substrings,
    tokens,
    toxicity,
    trie,
    vectors,
    warc,
)
from quotegrid.llm.common import hold_out, table
from quotegrid.llm.sql import LLM_ORACLE_SQL

__all__ = ["LLM_ORACLE_SQL", "LLM_QUERIES"]

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(query: Callable[[SparkSession, str], DataFrame]):
    LLM_QUERIES[query.__name__] = query
    return query


@register
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, by a machine that saw no held-out label."""
    judged = toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "row.doc_id",
        hold_out(F.col("row.doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@register
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and checksum of every document's pieces, and whether they decode to the text."""
    return pieces.summarise_documents(table(spark, sf_dir, "documents"))


@register
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document, on shingles of four words."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@register
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a field that saw no held-out row."""
    return language.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", hold_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@register
def op5_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "part", "at")


@register
def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth vector."""
    return vectors.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, as read from the written files."""
    return tokens.token_files(table(spark, sf_dir, "documents"), with_ids=False)


@register
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, deleted lines and the SHA-256 of the remaining text of every document."""
    return lines.dedup_lines(table(spark, sf_dir, "documents")).select(
        "row.doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the adaptive verdict of every document."""
    return quality.adaptive_filter(table(spark, sf_dir, "documents")).drop("lang", "source")


@register
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and the SHA-256 of the remaining words of every document."""
    return substrings.digest(table(spark, sf_dir, "documents"))


@register
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length, digest and kind of every page's record, as read back from the archives."""
    return warc.page_records(table(spark, sf_dir, "pages"))


@register
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest edits of every damaged conversation."""
    return repair.repair_report(table(spark, sf_dir, "conversations"))


@register
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
