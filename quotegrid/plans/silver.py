"""Bronze -> Silver."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.functions.scalars import moment
from quotegrid.operators.latest import latest_per_key, refresh_latest
from quotegrid.operators.quality import quality_gate
from quotegrid.operators.units import normalise_units, perf_adjust
from quotegrid.reference_data import SKU_PREFIX, UNITS_PER_INSTANCE
from quotegrid.schemas import LOAD, PERF_COLUMNS, RAW_ONLY, SILVER
from quotegrid.sources.tables import keep, read_kept


def current_quotes(bronze: DataFrame, filter_first: bool = False) -> DataFrame:
    """Latest quote per key that passes the gate.

    By default a bad newest row hides its key, as the gate comes after the pick; with
    ``filter_first`` the newest good row is taken.
    """
    raw = bronze.drop(*RAW_ONLY)
    if filter_first:
        return latest_per_key(quality_gate(raw))
    return quality_gate(latest_per_key(raw))


def advance_latest(bronze: DataFrame, target: str) -> DataFrame:
    """Latest rows per key kept in ``target``, brought up to date with ``bronze``.

    Only the load of the newest kept row and later ones are read, whose numbers are folders of
    Bronze; no clock is involved, and merging a load twice changes nothing. Rows without a
    load number are always read. The first call reads all rows.
    """
    raw, current = bronze.drop(*RAW_ONLY), read_kept(bronze.sparkSession, target)
    if current is not None:
        seen = current.agg(F.max(LOAD)).first()[0]
        later = F.col(LOAD).isNull() | (F.col(LOAD) >= F.lit(seen))
        arrived = raw if seen is None else raw.where(later)
        newest = refresh_latest(current, arrived)
    else:
        newest = latest_per_key(raw)
    return keep(newest, target)


def build_silver(
    bronze: DataFrame,
    units: Mapping[str, int] | DataFrame = UNITS_PER_INSTANCE,
    strip: str = SKU_PREFIX,
    weights: Mapping[str, float] | DataFrame | None = None,
    filter_first: bool = False,
    as_of: str | dt.datetime | None = None,
) -> DataFrame:
    """Current quotes per unit; ``weights`` adds the performance columns."""
    return silver_rows(current_quotes(bronze, filter_first), units, strip, weights, as_of)


def silver_rows(
    clean: DataFrame,
    units: Mapping[str, int] | DataFrame = UNITS_PER_INSTANCE,
    strip: str = SKU_PREFIX,
    weights: Mapping[str, float] | DataFrame | None = None,
    as_of: str | dt.datetime | None = None,
) -> DataFrame:
    """Silver columns of rows that are deduped and clean already."""
    silver = normalise_units(clean, units, strip)
    columns = list(SILVER.names)
    if weights is not None:
        silver = perf_adjust(silver, weights)
        columns += PERF_COLUMNS.names
    return silver.withColumn("transformed_at", moment(as_of)).select(*columns)
