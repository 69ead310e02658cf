"""Published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from quotegrid.operators.history import latest_snapshot
from quotegrid.operators.index import median_column, spread_columns
from quotegrid.reference_data import PROVIDERS


def index_report(gold: DataFrame, providers: Sequence[str] = PROVIDERS) -> DataFrame:
    """Latest index row per tier, cheapest tier first."""
    base, *others = providers
    spreads = [c for p in others for c in spread_columns(p, len(providers))]
    return (
        latest_snapshot(gold)
        .select(
            "tier",
            "index_median",
            "index_p25",
            "index_p75",
            "index_stddev",
            *[median_column(p) for p in providers],
            *spreads,
            "best_value_provider",
            "best_value_instance",
            "sample_size",
        )
        .orderBy("index_median", "tier")
    )


def best_value_report(gold: DataFrame) -> DataFrame:
    """Cheapest instance of each tier in its latest snapshot."""
    return (
        latest_snapshot(gold)
        .select(
            "tier",
            "index_median",
            "best_value_provider",
            "best_value_instance",
            "best_value_hw",
            "best_value_price",
            "best_value_unit_price",
        )
        .orderBy("index_median", "tier")
        .drop("index_median")
    )
