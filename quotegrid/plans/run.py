"""The daily run: catalogues -> landing -> Bronze -> Silver -> Gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid import reference_data as ref
from quotegrid.operators.index import index_universe
from quotegrid.operators.profile import frequency, layer_counts, tier_summary
from quotegrid.operators.quality import one_currency, quality_gate
from quotegrid.operators.sketches import index_of_summaries, price_summaries
from quotegrid.operators.units import normalise_units
from quotegrid.plans.gold import build_gold
from quotegrid.plans.latest import advance_parts, latest_rows
from quotegrid.plans.silver import build_silver, silver_rows
from quotegrid.schemas import (
    BRONZE,
    CATALOG_A_PRODUCTS,
    CATALOG_A_TERMS,
    CATALOG_B_RAW_PAGE,
    LOAD,
    PERF_COLUMNS,
    RAW_ONLY,
    SILVER,
)
from quotegrid.sources.catalogs import flatten_pages, flatten_terms
from quotegrid.sources.landing import land
from quotegrid.sources.tables import (
    append,
    ensure_database,
    exists,
    is_path,
    read,
    replace,
    write_snapshot,
)
from quotegrid.streaming.bronze import (
    drain,
    load_counts,
    next_load,
    note_load,
    split_corrupt,
    stream_landing,
)
from quotegrid.streaming.growth import bronze_schema, grow, promoted_columns


@dataclass(frozen=True)
class Paths:
    """Where a run reads and writes; each table is a folder or a catalogue name.

    The raw catalogues may be tables too, bucketed by SKU (``tables.write_bucketed``), so that
    products and terms join without a shuffle. A run keeps the latest rows in ``latest`` and
    reads only newly loaded ones, unless it is not ``incremental``; then it dedupes the whole of
    Bronze. Loaded landing files move to ``archive``, if given. Tables that are not named lie
    beside Bronze, Silver and Gold.
    """

    products: str
    terms: str
    pages: str
    landing: str
    checkpoint: str
    bronze: str
    silver: str
    gold: str
    latest: str | None = None
    region_a: str = "us-east-1"
    regions_b: Sequence[str] = tuple(ref.B_REGIONS)
    archive: str | None = None
    incremental: bool = True
    versions: str | None = None
    loads: str | None = None
    summaries: str | None = None

    def beside(self, name: str) -> str:
        """The table of latest rows, schema versions, loads or price summaries."""
        home = {"latest": self.silver, "summaries": self.gold}.get(name, self.bronze)
        return getattr(self, name) or f"{home.rstrip('/')}_{name}"


def raw_catalog(spark: SparkSession, source: str, schema: T.StructType) -> DataFrame:
    """A raw catalogue: JSON lines in a folder, or a table."""
    return spark.read.schema(schema).json(source) if is_path(source) else spark.table(source)


def land_catalogs(spark: SparkSession, paths: Paths) -> None:
    """Flatten both catalogues into one landing sub-folder per provider."""
    rows_a = flatten_terms(
        raw_catalog(spark, paths.products, CATALOG_A_PRODUCTS),
        raw_catalog(spark, paths.terms, CATALOG_A_TERMS),
        paths.region_a,
    )
    rows_b = flatten_pages(raw_catalog(spark, paths.pages, CATALOG_B_RAW_PAGE), paths.regions_b)
    land(rows_a, f"{paths.landing}/{ref.PROVIDER_A.lower()}")
    land(rows_b, f"{paths.landing}/{ref.PROVIDER_B.lower()}")


def good_bronze(spark: SparkSession, paths: Paths) -> DataFrame:
    """Bronze without quarantined rows; empty before the first row was ever loaded."""
    if not exists(spark, paths.bronze):
        return split_corrupt(spark.createDataFrame([], BRONZE))[0]
    return split_corrupt(read(spark, paths.bronze, BRONZE).select(*BRONZE.names))[0]


def load_landing(spark: SparkSession, paths: Paths) -> int:
    """Drain the landing folder into Bronze as one load; its number.

    Promoted columns are typed, new fields become columns of the next load, and the load's row
    counts are noted as they were observed.
    """
    load, versions = next_load(spark, paths.bronze), paths.beside("versions")
    promoted = promoted_columns(spark, versions)
    stream = stream_landing(
        spark, paths.landing, load=load, archive=paths.archive, promoted=promoted
    )
    counts = drain(stream, paths.bronze, paths.checkpoint, promoted)
    note_load(spark, paths.beside("loads"), load, counts)
    if exists(spark, paths.bronze):
        grow(spark, grown_bronze(spark, paths), versions)
    return load


def grown_bronze(spark: SparkSession, paths: Paths) -> DataFrame:
    """Bronze with all its columns, those that turned up later included."""
    if not is_path(paths.bronze):
        return spark.table(paths.bronze)
    return read(spark, paths.bronze, bronze_schema(spark, paths.beside("versions")))


def summarise_loads(spark: SparkSession, paths: Paths, bronze: DataFrame) -> DataFrame:
    """Price summaries of all loads; those of loads without any are added first."""
    target = paths.beside("summaries")
    seen = read(spark, target).agg(F.max(LOAD)).first()[0] if exists(spark, target) else None
    news = bronze if seen is None else bronze.where(F.col(LOAD) > F.lit(seen))
    quotes = index_universe(normalise_units(quality_gate(news.drop(*RAW_ONLY))))
    found = price_summaries(quotes)
    if seen is None or not found.isEmpty():
        append(found.coalesce(1), target)
    return read(spark, target)


def run(
    spark: SparkSession,
    paths: Paths,
    as_of: str | dt.datetime | None = None,
    snapshot_mode: str = "append",
    currency: str | None = None,
    weights: Mapping[str, float] | DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Land, drain, bring Silver up to date and add one Gold snapshot; safe to repeat.

    Nothing landed so far is no error: the tables stay empty. With ``currency`` quotes stated
    in another one are left out, as prices are never converted; each currency has latest rows of
    its own. ``weights`` add the performance columns to Silver. The result holds the run's
    checks as lazy frames: rows per provider and tier in Bronze, rows per layer, rows per load,
    average prices per tier in Silver, and the approximate index over all loads.
    """
    for table in (paths.bronze, paths.silver, paths.gold, paths.beside("latest")):
        if not is_path(table) and "." in table:
            ensure_database(spark, table.rsplit(".", 1)[0])
    land_catalogs(spark, paths)
    load_landing(spark, paths)
    bronze = good_bronze(spark, paths)
    latest = paths.beside("latest")
    if currency:
        bronze, latest = one_currency(bronze, currency), f"{latest}_{currency.lower()}"
    if paths.incremental:
        advance_parts(bronze, latest)
        rows = latest_rows(spark, latest) if exists(spark, latest) else bronze.drop(*RAW_ONLY)
        silver = silver_rows(quality_gate(rows), weights=weights, as_of=as_of)
    else:
        silver = build_silver(bronze, weights=weights, as_of=as_of)
    replace(silver, paths.silver)
    columns = SILVER.fields if weights is None else [*SILVER.fields, *PERF_COLUMNS.fields]
    silver = read(spark, paths.silver, T.StructType(columns))
    gold = build_gold(silver, as_of=as_of)
    write_snapshot(gold, paths.gold, snapshot_mode)
    return {
        "bronze": frequency(bronze, "provider", "tier"),
        "layers": layer_counts(bronze),
        "loads": load_counts(spark, paths.beside("loads"), paths.bronze),
        "silver": tier_summary(silver),
        "all_loads": index_of_summaries(summarise_loads(spark, paths, bronze)),
    }
