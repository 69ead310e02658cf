"""Silver -> Gold: one index row per tier."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.functions.scalars import moment, run_id
from quotegrid.operators.index import (
    BEST_VALUE,
    INDEX_COLUMNS,
    PICK_ORDER,
    PRICE,
    best_value,
    index_universe,
    median_column,
    moments,
    spread_columns,
    summarised,
    with_spreads,
)
from quotegrid.operators.joins import join_groups
from quotegrid.operators.quantiles import (
    QUARTILES,
    approx_quantile,
    approx_quantiles,
    histogram_quantiles,
    value_histogram,
)
from quotegrid.reference_data import EDGE_TIER, PROVIDERS


def stamp(df: DataFrame, as_of: str | dt.datetime | None = None) -> DataFrame:
    """Add the snapshot's date, time and run id, all of one instant."""
    now = moment(as_of)
    return df.withColumns(
        {"index_date": F.to_date(now), "index_timestamp": now, "run_id": run_id(now)}
    )


def assemble_gold(
    index: DataFrame, spread: DataFrame, best: DataFrame, keys: Sequence[str] = ("tier",)
) -> DataFrame:
    """Left joins of the three per-tier results."""
    return join_groups(join_groups(index, spread, keys), best, keys)


def _gold_columns(keys: Sequence[str], providers: Sequence[str], base: str) -> list[str]:
    spreads = [c for p in providers if p != base for c in spread_columns(p, len(providers))]
    medians = [median_column(p) for p in providers]
    return [*keys, *INDEX_COLUMNS, *medians, *spreads, *BEST_VALUE]


def _cheapest() -> Column:
    """Best-value pick as an aggregate: the least (unit price, tie-breaks) row."""
    unpriced = F.col(PRICE).isNull().alias("_unpriced")
    return F.min(F.struct(unpriced, *PICK_ORDER)).alias("_best")


def _best_columns() -> list[Column]:
    return [F.col(f"_best.{source}").alias(name) for name, source in BEST_VALUE.items()]


def index_rows(
    universe: DataFrame,
    providers: Sequence[str] = PROVIDERS,
    base: str | None = None,
    keys: Sequence[str] = ("tier",),
    approx: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """Index, provider medians, spreads and best value per group.

    ``approx`` does all in a single shuffle with mergeable sketches. In the exact form one
    histogram of prices per group and provider serves the quartiles and all provider medians.
    """
    keys, base = list(keys), base or providers[0]
    columns = _gold_columns(keys, providers, base)
    if approx:
        sketch, quartiles = approx_quantiles(PRICE, QUARTILES, accuracy)
        medians = [
            approx_quantile(F.when(F.col("provider") == p, F.col(PRICE)), 0.5, accuracy).alias(
                median_column(p)
            )
            for p in providers
        ]
        rows = universe.groupBy(*keys).agg(sketch, *medians, *moments(), _cheapest())
        rows = rows.select("*", *quartiles, *_best_columns())
        return with_spreads(rows, providers, base).select(*columns)

    # Scope 0 is all providers, scope n the n-th one; other providers only count in scope 0.
    position = F.array_position(F.array(*[F.lit(p) for p in providers]), F.col("provider"))
    scopes = F.array(F.lit(0).cast("bigint"), F.nullif(position, F.lit(0)))
    histogram = value_histogram(universe, [*keys, "provider"], PRICE)
    scoped = histogram.withColumn("_scope", F.explode(scopes)).where("_scope is not null")
    quantiles = histogram_quantiles(scoped.drop("provider"), [*keys, "_scope"], QUARTILES)

    def in_scope(scope: int, name: str, alias: str) -> Column:
        return F.max(F.when(F.col("_scope") == scope, F.col(name))).alias(alias)

    quantiles = quantiles.groupBy(*keys).agg(
        *[in_scope(0, name, name) for name in QUARTILES],
        *[in_scope(i, "index_median", median_column(p)) for i, p in enumerate(providers, 1)],
    )
    rows = join_groups(summarised(universe, keys), quantiles, keys)
    rows = join_groups(rows, best_value(universe, keys), keys)
    return with_spreads(rows, providers, base).select(*columns)


def build_gold(
    silver: DataFrame,
    providers: Sequence[str] = PROVIDERS,
    base: str | None = None,
    as_of: str | dt.datetime | None = None,
    approx: bool = False,
    exclude_tiers: Sequence[str] = (EDGE_TIER,),
) -> DataFrame:
    """One stamped snapshot of the index."""
    universe = index_universe(silver, exclude_tiers=exclude_tiers)
    return stamp(index_rows(universe, providers, base, approx=approx), as_of)
