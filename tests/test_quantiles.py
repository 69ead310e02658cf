"""Exact quantiles against a brute-force ranking."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotegrid.operators.quantiles import approx_quantile, exact_quantiles

PROBS = {"p07": 0.07, "p14": 0.14, "p28": 0.28, "p55": 0.55, "p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}


def brute(values, p):
    ordered = sorted(values)
    share = Fraction(str(p))  # as written, not as a binary fraction
    return ordered[max(math.ceil(len(ordered) * share), 1) - 1]


def check(spark, groups, partitions=3):
    rows = [(g, v) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(partitions)
    got = {r.g: r.asDict() for r in exact_quantiles(df, ["g"], "v", PROBS).collect()}
    for g, values in groups.items():
        known = [v for v in values if v is not None]
        if not known:
            assert g not in got
            continue
        for name, p in PROBS.items():
            assert got[g][name] == brute(known, p), (g, name)


def test_sizes_one_to_twenty(spark):
    check(spark, {str(n): [float(i) for i in range(n)] for n in range(1, 21)})


def test_one_group_with_a_third_equal(spark):
    rng = random.Random(7)
    values = [round(rng.lognormvariate(1, 2), 4) for _ in range(4000)] + [2.5] * 2000
    check(spark, {"hot": values, "small": [1.0, None], "none": [None]}, partitions=8)


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("g", 2.0)], "g string, v double")
    got = {r.g: r.q for r in exact_quantiles(df, ["g"], "v", {"q": 1.0}).collect()}
    assert got == {None: 3.0, "g": 2.0}


def test_signs_sizes_and_infinities(spark):
    values = [-1e12, -3.5, -0.0001, -0.00001, 0.0, 0.00001, 0.0001, 7.0, 1e12]
    check(spark, {"g": values + [float("inf"), float("-inf"), 1e300, -1e300]})


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, width=32), min_size=1, max_size=60))
def test_any_floats(spark, values):
    check(spark, {"g": [v + 0.0 for v in values]})


def test_shares_of_a_hundred(spark):
    check(spark, {"g": [float(i) for i in range(1, 101)], "h": [float(i) for i in range(300)]})


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_whole_numbers(spark, kind):
    scale = {"int": 300_000, "bigint": 10**15}[kind]
    rows = spark.range(1, 101).select(F.lit("g").alias("g"), (F.col("id") * scale).alias("v"))
    rows = rows.withColumn("v", F.col("v").cast(kind))
    got = exact_quantiles(rows, ["g"], "v", {"q": 0.07}).first()
    assert got.q == 7 * scale


def test_close_values_spread_over_ranges(spark):
    """Split points follow the values, however small or close these are."""
    from quotegrid.operators import quantiles

    rows = spark.range(200_000).select(
        F.lit("g").alias("g"), (F.col("id") / 200_000 * 1e-4).alias("v")
    )
    seen = []
    keep = quantiles.settle
    small = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(small, "64k")  # else a table this small is one range
    quantiles.settle = lambda df, name: seen.append(keep(df, name)) or seen[-1]
    try:
        got = exact_quantiles(rows, ["g"], "v", {"q": 0.5}).first().q
    finally:
        quantiles.settle = keep
        spark.conf.unset(small)
    assert got == 99_999 / 200_000 * 1e-4
    sizes = [r["count"] for r in seen[0].groupBy("_range").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * 200_000


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 19])
def test_sketch_equals_exact_on_small_groups(spark, n):
    df = spark.range(n).select(F.col("id").cast("double").alias("v"), F.lit("g").alias("g"))
    exact = exact_quantiles(df, ["g"], "v", {"q": 0.5}).first().q
    assert df.select(approx_quantile("v", 0.5)).first()[0] == exact
