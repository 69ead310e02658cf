"""Reads of the index history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.operators.latest import latest_per_key

TS = "index_timestamp"


def as_of(gold: DataFrame, ts: str | dt.datetime) -> DataFrame:
    """All snapshots taken up to ``ts``.

    The date bound follows from the time bound and lets Spark skip the folders of later
    dates. It leaves a day of slack, as the writer may have dated in another zone.
    """
    cutoff = F.lit(ts).cast(gold.schema[TS].dataType)
    kept = gold.where(F.col(TS) <= cutoff)
    if "index_date" in gold.columns:
        kept = kept.where(F.col("index_date") <= F.date_add(F.to_date(cutoff), 1))
    return kept


def version_as_of(gold: DataFrame, n: int) -> DataFrame:
    """The history as it was at version ``n``, counting snapshots from 0."""
    versions = gold.select(TS).distinct().orderBy(TS).limit(n + 1)
    return gold.join(versions, TS, "left_semi").select(*gold.columns)


def latest_snapshot(gold: DataFrame, keys: Sequence[str] = ("tier",)) -> DataFrame:
    """The newest row per tier."""
    return latest_per_key(gold, list(keys), ts=TS)


def latest_as_of(
    gold: DataFrame, ts: str | dt.datetime, keys: Sequence[str] = ("tier",)
) -> DataFrame:
    """The index as it was known at ``ts``."""
    return latest_snapshot(as_of(gold, ts), keys)
