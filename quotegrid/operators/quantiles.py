"""Group quantiles that are observed values, exact or by sketch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.operators.joins import join_groups
from quotegrid.sources.tables import settle

QUARTILES = {"index_p25": 0.25, "index_median": 0.5, "index_p75": 0.75}


def approx_quantile(col: Column | str, p: float, accuracy: int = 10_000) -> Column:
    """Mergeable sketch; its rank is off by at most rows / accuracy."""
    return F.percentile_approx(col, p, accuracy)


def approx_quantiles(
    col: Column | str, probs: Mapping[str, float], accuracy: int = 10_000
) -> tuple[Column, list[Column]]:
    """One sketch for all of ``probs``: (aggregate, columns to select from its result)."""
    sketch = F.percentile_approx(col, list(probs.values()), accuracy).alias("_quantiles")
    return sketch, [F.col("_quantiles")[i].alias(name) for i, name in enumerate(probs)]


def value_histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct non-null values per group as ``_value``, with ``_n`` rows.

    Equal values are counted before the shuffle, which spreads a hot group by value.
    """
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def histogram_quantiles(
    histogram: DataFrame, keys: Sequence[str], probs: Mapping[str, float]
) -> DataFrame:
    """Per group the smallest value whose cumulative share reaches each probability.

    No task ever holds a whole group: the histogram is dealt out by (group, value) into ranges
    of about equal size, whose split points Spark samples from the values themselves. Counts
    per range tell which one holds each wanted rank, and only the values of those ranges are
    ordered. The ranges are written, as a second sampling might split elsewhere. A value may
    stand in several rows of the histogram.
    """
    keys, named = list(keys), list(probs.items())
    dealt = histogram.repartitionByRange(*keys, "_value")
    histogram = settle(dealt.withColumn("_range", F.spark_partition_id()), "histogram")
    in_group = Window.partitionBy(*keys)
    upto = in_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = histogram.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in_range"))
    ranges = ranges.withColumns(
        {
            "_before": F.sum("_in_range").over(upto) - F.col("_in_range"),
            "_rows": F.sum("_in_range").over(in_group),
        }
    )
    ranks = {
        # In decimals: a binary 0.07 of 100 rows would end above the 7th.
        f"_rank_{name}": F.greatest(
            F.ceil(F.col("_rows").cast("decimal(20,0)") * F.lit(Decimal(str(p)))).cast("bigint"),
            F.lit(1),
        )
        for name, p in named
    }
    ranges = ranges.withColumns(ranks).where(
        reduce(
            or_,
            [
                (F.col(r) > F.col("_before"))
                & (F.col(r) <= F.col("_before") + F.col("_in_range"))
                for r in ranks
            ],
        )
    )

    in_range = Window.partitionBy(*keys, "_range").orderBy("_value")
    ordered = join_groups(histogram, ranges, [*keys, "_range"], "inner").withColumn(
        "_upto",
        F.col("_before")
        + F.sum("_n").over(in_range.rowsBetween(Window.unboundedPreceding, 0)),
    )
    picks = []
    for name, _ in named:
        rank = F.col(f"_rank_{name}")
        here = (rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n"))
        picks.append(F.max(F.when(here, F.col("_value"))).alias(name))
    return ordered.groupBy(*keys).agg(*picks)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]
) -> DataFrame:
    """Exact quantiles per group, null values aside; a group without values has no row."""
    return histogram_quantiles(value_histogram(df, keys, value), keys, probs)
