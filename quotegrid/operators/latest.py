"""Keyed picks: one row per key under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

QUOTE_KEYS = ["provider", "instance_type", "region", "price_type"]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key; every column left out of ``order`` breaks ties, nulls last.

    Rows that still tie are equal in all columns, so the result does not depend on the
    partitioning. Spark keeps one row per key and input partition before the shuffle
    (WindowGroupLimit), so a hot key sends at most one row per task.
    """
    rest = [
        # Maps have no order of their own; their text has.
        (F.to_json(c) if isinstance(df.schema[c].dataType, MapType) else F.col(c)).asc_nulls_last()
        for c in df.columns
        if c not in keys
    ]
    grouping = list(keys)
    if len(grouping) > 1:
        # Sorts compare eight bytes of the first column at a time; a hash of the whole key
        # decides nearly all comparisons there, where the first key column would seldom.
        df = df.withColumn("_hash", F.xxhash64(*keys))
        grouping.insert(0, "_hash")
    window = Window.partitionBy(*grouping).orderBy(*order, *rest)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where("_rank = 1").drop("_rank", "_hash")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = QUOTE_KEYS,
    order: Sequence[Column] | None = None,
    ts: str = "ingested_at",
) -> DataFrame:
    """Newest row per key; the default order prefers the lower price among equal times."""
    if order is None:
        order = [F.col(ts).desc_nulls_last()]
        if "price_per_hour" in df.columns:
            order.append(F.col("price_per_hour").asc_nulls_last())
    return first_per_key(df, keys, order)


def refresh_latest(
    current: DataFrame, arrived: DataFrame, keys: Sequence[str] = QUOTE_KEYS
) -> DataFrame:
    """Latest rows after new arrivals, from the former latest rows alone.

    Equal to ``latest_per_key`` over the whole history, since the pick is the maximum of a
    total order; a daily run then reads one day of raw rows rather than all of them.
    """
    return latest_per_key(current.unionByName(arrived), keys)
