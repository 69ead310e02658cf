"""The corpus pipeline: from raw documents to token ids, one operator of ``quotegrid.llm`` a stage.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
``documents``; the last one adds the ids. Each stage's result is written as Parquet and read
again, so the next one starts from a table. Null ids, null and empty texts, repeated rows, empty
tables and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.llm import lines, mixing, neardup, pieces, toxicity
from quotegrid.llm.common import bounded_batches, settle, table, text_of


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose score reaches the threshold."""
    judged = toxicity.judge(docs, table(spark, sf_dir, "labels"))
    return judged.filter(F.col("toxicity") < toxicity.THRESHOLD).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes common blocks from the later documents; a document left without a line goes."""
    bounded_batches(spark)
    found = lines.dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    changed = F.col("n_removed") > 0
    columns = [
        (F.when(changed, new[c]).otherwise(F.col("row")[c]) if c in new else F.col("row")[c]).alias(c)
        for c in docs.columns
    ]
    return found.filter(~changed | (F.trim("kept") != "")).select(*columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    bounded_batches(spark)
    return neardup.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Plays the sources at their target weights; a document taken twice is there twice."""
    bounded_batches(spark)
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``pieces``, the ids of the text, and ``decodes``, whether they decode to it, in place
    of columns so named."""
    bounded_batches(spark)
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    found = docs.select(row, pieces.checked(text_of()).alias("found"))
    plain = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("pieces", "decodes")]
    return found.select(*plain, "found.pieces", "found.decodes")


STAGES = [
    ("toxicity", toxicity_filter),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("sentencepiece", sentencepiece),
]

#: The stages learn, hash and align; tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
