"""Scalar helpers shared by the layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_price(offers: Column, currency: str = "USD") -> Column:
    """Price of the last rate of the last offer that has one, in document order.

    Null when that rate has no price in ``currency`` or the text is not a number.
    """
    last = F.try_element_at(all_rates(offers), F.lit(-1))
    return attribute(last["pricePerUnit"], currency).try_cast("double")


def all_rates(offers: Column) -> Column:
    """Rates of all offers of a SKU in document order; offers without rates are skipped."""
    priced = F.filter(F.map_values(offers), lambda o: o["priceDimensions"].isNotNull())
    return F.flatten(F.transform(priced, lambda o: F.map_values(o["priceDimensions"])))


def attribute(attributes: Column, key: str, default: str | None = None) -> Column:
    """Map entry, with an optional default for a missing key."""
    entry = F.try_element_at(attributes, F.lit(key))
    return entry if default is None else F.coalesce(entry, F.lit(default))


def unit_price(price: Column, units: Column, scale: int = 4) -> Column:
    """Price per unit, rounded half up; null for zero units."""
    return F.round(F.try_divide(price, units), scale)


def percent_of(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole``; null where ``whole`` is zero."""
    return F.round(F.try_divide(part, whole) * 100, scale)


#: Decimals that sums run in; eight digits after the point, below 1e16.
EXACT = "decimal(24,8)"


def mean(col: str, scale: int = 4, weight: str | None = None) -> Column:
    """Average rounded half up, summed in decimals: the same for any order of the rows.

    Values that are no such decimal (not a number, infinite, 1e16 and more) do not count.
    ``weight`` names a column that says how many rows a row stands for.
    """
    exact = F.col(col).try_cast(EXACT)
    if weight is None:
        return mean_of(F.sum(exact), F.count(exact), scale)
    times = F.when(exact.isNotNull(), F.col(weight))
    return mean_of(F.sum(exact * times.cast("decimal(14,0)")), F.sum(times), scale)


def mean_of(total: Column, rows: Column, scale: int = 4) -> Column:
    """The average from an exact sum."""
    quotient = F.try_divide(total.cast("decimal(34,8)"), rows.cast("decimal(14,0)"))
    return F.round(quotient, scale).cast("double")


#: A value in steps of 1e-8 is a * _LIMB + b, so that sums of squares fit 38 digits.
_STEPS, _SHIFT = 10**8, 13
_LIMB = _STEPS << _SHIFT
POWER_SUMS = ["_k", "_a", "_b", "_aa", "_ab", "_bb"]


def power_sums(col: str, weight: str | None = None) -> dict[str, Column]:
    """Aggregates that ``deviation_of`` needs, as exact decimals that may be added up.

    What they give does not depend on how rows were dealt out or merged; signed weights take
    rows away again. Groups may have 1e13 rows.
    """
    value = F.col(col).cast("double")
    counts = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < 1e16)
    whole = F.when(counts, F.floor(value)).cast("bigint")
    part = F.rint((value - whole) * float(_STEPS)).cast("bigint")
    inside = whole.bitwiseAND(F.lit((1 << _SHIFT) - 1).cast("bigint"))
    b = (inside * F.lit(_STEPS) + part).cast("decimal(12,0)")
    # Prices below 8,192 have no high part, and sums skip nulls.
    high = F.shiftright(whole, _SHIFT)
    a = F.when(high != 0, high.cast("decimal(13,0)"))
    terms = [F.when(counts, F.lit(Decimal(1))), a, b, a * a, a * b, b * b]
    if weight is not None:
        times = F.col(weight).cast("decimal(12,0)")
        terms = [(term * times).cast("decimal(38,0)") for term in terms]
    empty = F.when(F.count_if(counts) > 0, F.lit(Decimal(0)))
    return {
        name: F.coalesce(F.sum(term), empty).cast("decimal(38,0)").alias(name)
        for name, term in zip(POWER_SUMS, terms, strict=True)
    }


def deviation_of(sums: Mapping[str, Column]) -> Column:
    """Sample standard deviation from power sums; null below two rows.

    The sum of squares is taken around the rounded mean and stays a whole number to the end,
    so nothing cancels. Where it exceeds 38 digits its parts are added as doubles.
    """

    def whole(x: Column) -> Column:
        return x.cast("decimal(38,0)")

    def times(*factors: Column) -> Column:
        return reduce(lambda x, y: whole(F.try_multiply(x, y)), map(whole, factors))

    def plus(*terms: Column) -> Column:
        return reduce(lambda x, y: whole(F.try_add(x, y)), map(whole, terms))

    k, a, b, aa, ab, bb = (whole(sums[name]) for name in POWER_SUMS)
    limb, two = F.lit(Decimal(_LIMB)), F.lit(Decimal(2))
    total = plus(times(a, limb), b)
    centre = whole(F.round(F.try_divide(total, k), 0))
    mb = whole(centre % limb)
    ma = whole(F.try_divide(plus(centre, -mb), limb))
    rest = plus(total, -times(k, centre)).cast("double")
    squares = plus(aa, -times(two, ma, a), times(k, ma, ma))
    mixed = plus(ab, -times(ma, b), -times(mb, a), times(k, ma, mb))
    lows = plus(bb, -times(two, mb, b), times(k, mb, mb))
    exact = plus(times(squares, limb, limb), times(two, mixed, limb), lows).cast("double")
    rough = squares.cast("double") * float(_LIMB) ** 2 + mixed.cast("double") * (2.0 * _LIMB)
    spread = F.coalesce(exact, rough + lows.cast("double")) - rest * rest / k.cast("double")
    return F.when(k > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (k - 1).cast("double")) / _STEPS)


def deviation(col: str, weight: str | None = None) -> Column:
    """Sample standard deviation, bit for bit the same for any order of the rows.

    Values that ``mean`` leaves out do not count here either.
    """
    return deviation_of(power_sums(col, weight))


def moment(as_of: str | dt.datetime | None = None) -> Column:
    """The given instant, or the start time of the query."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")
