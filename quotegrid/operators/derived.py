"""Figures derived from finished index rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.functions.scalars import percent_of


def dispersion(gold: DataFrame) -> DataFrame:
    """Add the deviation as a percentage of the median and the interquartile range."""
    return gold.withColumns(
        {
            "stddev_pct": percent_of(F.col("index_stddev"), F.col("index_median"), 0),
            "iqr": F.round(F.col("index_p75") - F.col("index_p25"), 4),
        }
    )


def tier_premium(
    gold: DataFrame,
    base_tier: str,
    by: Sequence[str] = ("index_timestamp",),
    scale: int = 2,
) -> DataFrame:
    """Add ``premium``: each tier's median over that of ``base_tier`` in the same snapshot."""
    base_median = F.max(F.when(F.col("tier") == base_tier, F.col("index_median")))
    ratio = F.try_divide(F.col("index_median"), base_median.over(Window.partitionBy(*by)))
    return gold.withColumn("premium", F.round(ratio, scale))
