"""Plans that must hold at scale."""

import re

import pytest
from helpers import T1, bronze
from pyspark.sql import functions as F

from quotegrid.operators import index
from quotegrid.operators.latest import latest_per_key
from quotegrid.operators.quantiles import exact_quantiles, value_histogram
from quotegrid.operators.units import normalise_units
from quotegrid.plans import silver as silver_plan
from quotegrid.plans.gold import index_rows
from quotegrid.plans.silver import build_silver
from quotegrid.schemas import BRONZE


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final(df):
    df.collect()
    return executed(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    """Line items as unpartitioned quotes with a unit price."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_returnflag").alias("tier"),
        F.col("l_linestatus").alias("provider"),
        F.col("l_partkey").cast("string").alias("instance_type"),
        F.col("l_suppkey").cast("string").alias("region"),
        F.lit("x").alias("hw_type"),
        F.lit("on_demand").alias("price_type"),
        F.col("l_extendedprice").alias("price_per_hour"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_shipdate").alias("ingested_at"),
    )


def test_pick_keeps_one_row_per_key_before_the_shuffle(lines):
    plan = executed(latest_per_key(lines, ["provider", "region"]))
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_lookup_is_broadcast_and_shuffles_nothing(lines):
    plan = executed(normalise_units(lines))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_approximate_gold_shuffles_once(lines):
    plan = executed(index_rows(lines, ["O", "F"], approx=True))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_exact_quantiles_count_before_the_shuffle(lines):
    df = exact_quantiles(lines, ["tier"], "unit_price", {"q": 0.5})
    # Equal values are counted before the first shuffle; what follows reads the written ranges.
    histogram = executed(value_histogram(lines, ["tier"], "unit_price"))
    assert "partial_count" in histogram
    assert re.search(r"Exchange hashpartitioning\(tier#\d+, unit_price#\d+", histogram)
    assert "_range" in executed(df) and "l_extendedprice" not in executed(df)


def test_scan_reads_only_what_is_needed(lines):
    plan = executed(index.tier_index(index.index_universe(lines)))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    written = {s for s in schemas if "_range" in s}
    assert schemas - written == {"l_extendedprice:double,l_returnflag:string"}
    assert "Not(EqualTo(l_returnflag,Edge))" in plan


def test_silver_skips_the_raw_payload(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    bronze(spark, {"raw_payload": "{}"}).write.parquet(path)
    plan = executed(build_silver(spark.read.schema(BRONZE).parquet(path)))
    (columns,) = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert "ingested_at" in columns
    assert not any(c in columns for c in ("raw_payload", "vcpu", "memory_gb", "_corrupt_record"))


def test_incremental_load_prunes_bronze_by_load(spark, tmp_path, monkeypatch):
    seen = []
    keep = silver_plan.keep
    monkeypatch.setattr(
        silver_plan, "keep", lambda df, p: seen.append(executed(df)) or keep(df, p)
    )
    path = f"{tmp_path}/bronze"
    rows = bronze(spark, {"load": 1}, {"load": 2, "ingested_at": T1, "region": "x"})
    rows.write.partitionBy("load").parquet(path)
    for _ in range(2):
        rows = silver_plan.advance_latest(spark.read.schema(BRONZE).parquet(path), f"{tmp_path}/l")
    assert rows.count() == 2
    assert not re.search(r"PartitionFilters: \[[^\]]*load", seen[0])
    assert re.search(r"PartitionFilters: \[[^\]]*load#\d+ >= 2", seen[1])
