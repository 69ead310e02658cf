"""Lookups: units per instance and performance weight per hardware."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid.functions.scalars import unit_price
from quotegrid.reference_data import PERF_WEIGHTS, SKU_PREFIX, UNITS_PER_INSTANCE, UNKNOWN_HW

BROADCAST_BYTES = 8 << 20


def lookup(
    spark: SparkSession, mapping: Mapping, key: str, value: str, kind: T.DataType
) -> DataFrame:
    """Two-column dimension from a mapping, whose keys are unique by nature."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(value, kind)])
    return spark.createDataFrame(list(mapping.items()), schema)


def _left_lookup(
    df: DataFrame, dim: Mapping | DataFrame, key: str, value: str, kind: T.DataType
) -> DataFrame:
    """Left join to a lookup: a mapping, or a dimension table of (key, value) columns.

    Rows built from a list carry no size estimate, so a mapping is broadcast while its texts
    have at most BROADCAST_BYTES. A larger one, and a table, is joined without a hint; a table
    must not state a key twice.
    """
    if isinstance(dim, DataFrame):
        its_key, its_value = dim.columns[:2]
        table = dim.select(F.col(its_key).alias(key), F.col(its_value).cast(kind).alias(value))
        return df.join(table, key, "left")
    small = sum(len(str(k)) + 32 for k in dim) <= BROADCAST_BYTES
    table = lookup(df.sparkSession, dim, key, value, kind)
    return df.join(F.broadcast(table) if small else table, key, "left")


def normalise_units(
    df: DataFrame,
    units: Mapping[str, int] | DataFrame = UNITS_PER_INSTANCE,
    strip: str = SKU_PREFIX,
    scale: int = 4,
) -> DataFrame:
    """Add ``unit_count`` (1 for a miss), ``unit_count_known`` and ``unit_price``."""
    keyed = df.withColumn("_key", F.regexp_replace("instance_type", strip, ""))
    joined = _left_lookup(keyed, units, "_key", "_units", T.LongType())
    counted = joined.withColumns(
        {
            "unit_count": F.coalesce("_units", F.lit(1).cast("bigint")),
            "unit_count_known": F.col("_units").isNotNull(),
        }
    ).drop("_key", "_units")
    return counted.withColumn(
        "unit_price", unit_price(F.col("price_per_hour"), F.col("unit_count"), scale)
    )


def perf_adjust(
    df: DataFrame,
    weights: Mapping[str, float] | DataFrame = PERF_WEIGHTS,
    default: str = UNKNOWN_HW,
    scale: int = 4,
) -> DataFrame:
    """Add ``perf_index`` (weight of ``default`` for a miss) and ``price_per_perf_unit``.

    Opt-in: the headline index never uses it. A weight table without ``default`` counts a
    miss by the fixed weight.
    """
    fallback = PERF_WEIGHTS[UNKNOWN_HW]
    if isinstance(weights, DataFrame):
        key, value = (F.col(c) for c in weights.columns[:2])
        stated = weights.where(key == default).agg(F.max(value)).first()[0]  # one value
        fallback = fallback if stated is None else stated
    else:
        fallback = weights[default]
    joined = _left_lookup(df, weights, "hw_type", "_weight", T.DoubleType())
    weighted = joined.withColumn(
        "perf_index", F.coalesce("_weight", F.lit(float(fallback)))
    ).drop("_weight")
    return weighted.withColumn(
        "price_per_perf_unit", unit_price(F.col("unit_price"), F.col("perf_index"), scale)
    )
