"""Latest rows per key, kept in parts by key hash: a load rewrites the parts it touches.

A part lies in one of two slots, its rows with a version number; the slot with the higher one
counts. A new version goes to the other slot as a single file, which appears as a whole or not
at all, so a run that dies leaves each part in its old or its new state. Merging a load twice
changes nothing, hence the next run simply merges it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotegrid.operators.latest import QUOTE_KEYS, latest_per_key, refresh_latest
from quotegrid.schemas import LOAD, RAW_ONLY
from quotegrid.sources.tables import append, exists, overwrite_partitions, read

#: Parts of a state; a part should fit a file of a few hundred MB. Fixed for the life of a state.
PARTS = 256
PART, SLOT, VERSION = "_part", "_slot", "_version"


def part_of(keys: Sequence[str] = QUOTE_KEYS, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def _merged_table(target: str) -> str:
    """Beside the state: the numbers of the loads that are merged."""
    return f"{target}_merged"


def read_parts(
    spark: SparkSession, target: str, parts: Sequence[int] | None = None
) -> DataFrame:
    """The kept rows, of some parts only if given; other parts' files are not opened."""
    rows = read(spark, target)
    if parts is not None:
        rows = rows.where(F.col(PART).isin(list(parts)))
    newest = rows.groupBy(PART).agg(F.max(VERSION).alias(VERSION))
    # One row per part, of which there are PARTS.
    return rows.join(F.broadcast(newest), [PART, VERSION])


def latest_rows(spark: SparkSession, target: str) -> DataFrame:
    """The latest row of every key."""
    return read_parts(spark, target).drop(PART, SLOT, VERSION)


def advance_parts(
    bronze: DataFrame,
    target: str,
    keys: Sequence[str] = QUOTE_KEYS,
    parts: int = PARTS,
) -> list[int]:
    """Bring the kept rows up to date with the loads not merged yet; the parts rewritten.

    Only those loads are read, whose numbers are folders of Bronze, and only the parts in which
    their keys lie. Rows without a load number are always read. The first call reads all rows.
    """
    spark, raw = bronze.sparkSession, bronze.drop(*RAW_ONLY)
    merged, known = _merged_table(target), exists(spark, target)
    seen = None
    if known and exists(spark, merged):
        seen = read(spark, merged).agg(F.max(LOAD)).first()[0]
    arrived = raw if seen is None else raw.where(F.col(LOAD).isNull() | (F.col(LOAD) > F.lit(seen)))
    arrived = arrived.withColumn(PART, part_of(keys, parts))
    news = arrived.groupBy(PART).agg(F.max(LOAD).alias(LOAD)).collect()  # PARTS rows at most
    touched = sorted(r[PART] for r in news)
    if not touched:
        return []
    slots, version = {}, 0
    rows = arrived.drop(PART)
    if known:
        current = read_parts(spark, target, touched)
        held = current.select(PART, SLOT, VERSION).distinct().collect()  # a row per part
        slots, version = {r[PART]: r[SLOT] for r in held}, max((r[VERSION] for r in held), default=0)
        rows = refresh_latest(current.drop(PART, SLOT, VERSION).select(*rows.columns), rows, keys)
    else:
        rows = latest_per_key(rows, keys)
    other = F.create_map(*[F.lit(x) for p in touched for x in (p, 1 - slots.get(p, 1))])
    out = rows.withColumn(PART, part_of(keys, parts)).withColumns(
        {VERSION: F.lit(version + 1), SLOT: other[F.col(PART)]}
    )
    # One task per part, so a part's new version is one file.
    overwrite_partitions(out.repartition(PART), target, [PART, SLOT])
    numbers = [r[LOAD] for r in news if r[LOAD] is not None]
    if numbers:
        row = spark.createDataFrame([(max(numbers),)], f"{LOAD} int")
        append(row.coalesce(1), merged)
    return touched
