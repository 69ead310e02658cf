"""The turns of conversations, numbered in order without gathering a conversation in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotegrid.llm.common import settle


def turn_order() -> list[Column | str]:
    """By number, null first; equal numbers by role, then by text, of which 256 characters and a
    hash decide, as Spark samples the sort key for its ranges.
    """
    return ["turn", "role", F.substring("text", 1, 256), F.xxhash64("text")]


def numbered(rows: DataFrame, group: str, order: list[Column | str]) -> DataFrame:
    """``rows`` with ``pos``, 0 and up within ``group`` by ``order`` (nulls first), written once.

    The rows are sorted by ranges, so one group may span many tasks, equal rows too; a place in
    the file is then made a place in the group by adding the counts of the ranges before, of
    which there is one narrow row per group and task.
    """
    rows = rows.withColumn("_any", F.monotonically_increasing_id())
    by = [group, *order, "_any"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_any")
    rows = settle(rows.withColumn("_at", F.monotonically_increasing_id()), "turns")
    part = F.shiftright("_at", 33).alias("_part")
    counts = rows.groupBy(group, part).agg(F.min("_at").alias("_low"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_start")
    )
    placed = rows.withColumn("_part", part).join(starts, [group, "_part"])
    return placed.withColumn("pos", F.col("_at") + F.col("_start")).drop("_at", "_part", "_start")


def text_or(column: str, missing: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(missing))
