"""Counts and validation summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quotegrid.functions.scalars import mean
from quotegrid.operators.latest import QUOTE_KEYS
from quotegrid.operators.quality import accepted
from quotegrid.reference_data import DEFAULT_PRICE_TYPE
from quotegrid.schemas import LOAD, RAW_ONLY


def frequency(df: DataFrame, *keys: str) -> DataFrame:
    """Row count per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def region_pages(bronze: DataFrame) -> DataFrame:
    """Rows and distinct source files per region."""
    return bronze.groupBy("region").agg(
        F.count("*").alias("n"), F.count_distinct("source_file").alias("files")
    )


def source_inventory(bronze: DataFrame) -> DataFrame:
    """Loaded files with their row counts and load times."""
    return bronze.groupBy("provider", "source_file").agg(
        F.count("*").alias("n"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"),
    )


#: Size of the distinct-count sketches: 2^12 registers, a standard error of 1.04 / 64.
HLL_BITS = 12


def load_inventory(bronze: DataFrame) -> DataFrame:
    """Loaded files per load: rows and load times, to be kept and added up by ``inventory_of``."""
    return bronze.groupBy(LOAD, "provider", "source_file").agg(
        F.count("*").alias("n"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.max("ingested_at").alias("last_ingested_at"),
    )


def inventory_of(inventories: DataFrame) -> DataFrame:
    """``source_inventory`` from the kept rows of any loads."""
    return inventories.groupBy("provider", "source_file").agg(
        F.sum("n").alias("n"),
        F.min("first_ingested_at").alias("first_ingested_at"),
        F.max("last_ingested_at").alias("last_ingested_at"),
    )


def load_regions(bronze: DataFrame) -> DataFrame:
    """Rows per load and region, with a mergeable sketch of their source files."""
    return bronze.groupBy(LOAD, "region").agg(
        F.count("*").alias("n"), F.hll_sketch_agg("source_file", F.lit(HLL_BITS)).alias("files")
    )


def regions_of(regions: DataFrame) -> DataFrame:
    """``region_pages`` from the kept rows of any loads; the number of files is an estimate."""
    return regions.groupBy("region").agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("files")).alias("files")
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that is filled by whatever action runs it.

    A progress figure: tasks that are repeated after an executor loss may count twice. Use
    ``layer_counts`` where the number must be right.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def layer_counts(bronze: DataFrame, keys: Sequence[str] = QUOTE_KEYS) -> DataFrame:
    """Rows before the dedupe, after it and after the quality gate, in one pass.

    Per key it counts the rows and asks the gate about the row that the dedupe picks.
    """
    raw = bronze.drop(*RAW_ONLY)
    rest = [c for c in raw.columns if c not in (*keys, "ingested_at", "price_per_hour")]
    ascending = lambda c: (F.col(c).isNull(), F.col(c))
    time = F.unix_micros(F.col("ingested_at").cast("timestamp"))
    order = [time.isNull(), -time, *ascending("price_per_hour")]
    order += [x for c in rest for x in ascending(c)]
    first = F.struct(*(x.alias(f"_{i}") for i, x in enumerate(order)))
    per_key = raw.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.min_by(F.coalesce(accepted(), F.lit(False)), first).alias("clean"),
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_rows"),
        F.count("*").alias("deduped_rows"),
        F.count_if("clean").alias("clean_rows"),
    )


def tier_summary(silver: DataFrame, price_type: str = DEFAULT_PRICE_TYPE) -> DataFrame:
    """Average prices and row count per tier; the adjusted price only if Silver has it."""
    averages = [
        mean("price_per_hour").alias("avg_price_per_hour"),
        mean("unit_price").alias("avg_unit_price"),
    ]
    if "price_per_perf_unit" in silver.columns:
        averages.append(mean("price_per_perf_unit").alias("avg_perf_price"))
    return (
        silver.where(F.col("price_type") == price_type)
        .groupBy("tier")
        .agg(*averages, F.count("*").alias("n"))
    )
