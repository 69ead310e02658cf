"""Index aggregates: tier index, provider summary, provider spread, best value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.functions.scalars import deviation, mean, percent_of
from quotegrid.operators.joins import join_groups
from quotegrid.operators.latest import first_per_key
from quotegrid.operators.quantiles import (
    QUARTILES,
    approx_quantile,
    approx_quantiles,
    exact_quantiles,
)
from quotegrid.reference_data import DEFAULT_PRICE_TYPE, EDGE_TIER

PRICE = "unit_price"

BEST_VALUE = {
    "best_value_provider": "provider",
    "best_value_instance": "instance_type",
    "best_value_hw": "hw_type",
    "best_value_region": "region",
    "best_value_price": "price_per_hour",
    "best_value_unit_price": "unit_price",
}
PICK_ORDER = [PRICE, "price_per_hour", "provider", "instance_type", "region", "hw_type"]


def index_universe(
    silver: DataFrame,
    price_type: str = DEFAULT_PRICE_TYPE,
    exclude_tiers: Sequence[str] = (EDGE_TIER,),
) -> DataFrame:
    """Quotes that make up the index; with other tiers excluded, those of a sub-index."""
    universe = silver.where(F.col("price_type") == price_type)
    for tier in exclude_tiers:
        universe = universe.where(F.col("tier") != tier)
    return universe


def moments(weight: str | None = None) -> list[Column]:
    """Fixed-size aggregates, all combined before the shuffle, the same for any order of rows.

    ``weight`` names a column that says how many quotes a row stands for.
    """
    return [
        mean(PRICE, weight=weight).alias("index_mean"),
        F.round(deviation(PRICE, weight), 4).alias("index_stddev"),
        F.round(F.min(PRICE), 4).alias("price_floor"),
        F.round(F.max(PRICE), 4).alias("price_ceiling"),
        (F.sum(weight) if weight else F.count("*")).alias("sample_size"),
    ]


def summarised(universe: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``moments`` per group in two levels: equal prices are counted, then weighed.

    The sums in decimals then cost as much as there are prices, not quotes.
    """
    counted = universe.groupBy(*keys, PRICE).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(*moments("_n"))


INDEX_COLUMNS = [
    "index_median", "index_p25", "index_p75", "index_mean", "index_stddev",
    "price_floor", "price_ceiling", "sample_size",
]


def tier_index(
    universe: DataFrame,
    keys: Sequence[str] = ("tier",),
    approx: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Median, quartiles, mean, deviation, floor, ceiling and sample size per group."""
    keys = list(keys)
    if approx:
        sketch, quartiles = approx_quantiles(PRICE, QUARTILES, accuracy)
        rows = universe.groupBy(*keys).agg(sketch, *moments()).select("*", *quartiles)
        return rows.select(*keys, *INDEX_COLUMNS)
    quantiles = exact_quantiles(universe, keys, PRICE, QUARTILES)
    return join_groups(summarised(universe, keys), quantiles, keys).select(*keys, *INDEX_COLUMNS)


def provider_summary(
    universe: DataFrame,
    keys: Sequence[str] = ("tier",),
    approx: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Median, mean and sample size per group and provider."""
    keys = [*keys, "provider"]
    plain = [
        mean(PRICE).alias("provider_mean"),
        F.count("*").alias("sample_size"),
    ]
    columns = [*keys, "provider_median", "provider_mean", "sample_size"]
    if approx:
        sketch = approx_quantile(PRICE, 0.5, accuracy).alias("provider_median")
        return universe.groupBy(*keys).agg(sketch, *plain).select(*columns)
    medians = exact_quantiles(universe, keys, PRICE, {"provider_median": 0.5})
    summary = universe.groupBy(*keys).agg(*plain)
    return join_groups(summary, medians, keys).select(*columns)


def median_column(provider: str) -> str:
    return f"{provider.lower()}_median"


def spread_columns(provider: str, provider_count: int) -> tuple[str, str]:
    """Names of the spread columns; only a third provider makes the name part of them."""
    if provider_count == 2:
        return "provider_spread", "spread_pct"
    return f"{provider.lower()}_spread", f"{provider.lower()}_spread_pct"


def with_spreads(df: DataFrame, providers: Sequence[str], base: str) -> DataFrame:
    """Difference of each provider's median to the base provider's, also in percent.

    Null where either median is missing; the percentage is null for a zero base too.
    """
    reference = F.col(median_column(base))
    columns = {}
    for provider in providers:
        if provider != base:
            gap = F.col(median_column(provider)) - reference
            amount, percent = spread_columns(provider, len(providers))
            columns[amount] = F.round(gap, 4)
            columns[percent] = percent_of(gap, reference)
    return df.withColumns(columns)


def provider_spread(
    summary: DataFrame,
    providers: Sequence[str],
    base: str | None = None,
    keys: Sequence[str] = ("tier",),
) -> DataFrame:
    """Provider medians side by side, with spreads; ``base`` is the first one by default.

    The provider list is given, so the pivot needs no extra job and its columns are stable.
    """
    pivoted = (
        summary.groupBy(*keys)
        .pivot("provider", list(providers))
        .agg(F.first("provider_median"))
        .withColumnsRenamed({p: median_column(p) for p in providers})
    )
    return with_spreads(pivoted, providers, base or providers[0])


def best_value(universe: DataFrame, keys: Sequence[str] = ("tier",)) -> DataFrame:
    """Cheapest quote per unit in each group, ties broken by price, provider and names.

    A hash aggregate finds each group's floor, and the costlier ordering then sees the quotes
    at their own group's floor only; a group without a price keeps all its quotes.
    """
    floors = universe.groupBy(*keys).agg(F.min(PRICE).alias("_floor"))
    needed = universe.select(*keys, *dict.fromkeys([*PICK_ORDER, *BEST_VALUE.values()]))
    candidates = (
        join_groups(needed, floors, keys, "inner")
        .where(F.col("_floor").isNull() | (F.col(PRICE) <= F.col("_floor")))
        .drop("_floor")
    )
    order = [F.col(c).asc_nulls_last() for c in PICK_ORDER]
    picked = first_per_key(candidates, keys, order)
    return picked.select(*keys, *[F.col(c).alias(n) for n, c in BEST_VALUE.items()])
