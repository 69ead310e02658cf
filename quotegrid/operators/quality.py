"""Quality gate between the raw and the clean layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotegrid.reference_data import UNKNOWN_TIER

#: Sums of prices below it are exact; it also keeps infinities out.
MAX_PRICE = 1e15


def accepted() -> Column:
    """True for a usable quote. A hardware text of 'unknown' is usable, a null is not."""
    price, tier = F.col("price_per_hour"), F.col("tier")
    return (
        price.isNotNull()
        & (price > 0)
        & ~F.isnan(price)
        & (price < MAX_PRICE)
        & tier.isNotNull()
        & (tier != UNKNOWN_TIER)
        & F.col("hw_type").isNotNull()
    )


def reject_reason() -> Column:
    """Text of the first failed check, null for a usable quote."""
    price, tier = F.col("price_per_hour"), F.col("tier")
    return (
        F.when(price.isNull(), "price missing")
        .when(F.isnan(price), "price not a number")
        .when(price <= 0, "price not positive")
        .when(price >= MAX_PRICE, "price out of range")
        .when(tier.isNull(), "tier missing")
        .when(tier == UNKNOWN_TIER, "tier unknown")
        .when(F.col("hw_type").isNull(), "hardware missing")
    )


def quality_gate(df: DataFrame) -> DataFrame:
    return df.where(accepted())


def quality_rejects(df: DataFrame) -> DataFrame:
    """The rows that ``quality_gate`` drops, with ``reject_reason``."""
    return df.withColumn("reject_reason", reject_reason()).where("reject_reason is not null")


def one_currency(df: DataFrame, currency: str = "USD") -> DataFrame:
    """Quotes in ``currency``, taking an unstated one as such; prices are never converted."""
    return df.where(F.col("currency").isNull() | (F.col("currency") == currency))
