"""The series by signed changes against a run per month, and deviations by exact sums."""

import datetime as dt
import random

import pytest
from helpers import bronze, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quotegrid.functions.scalars import deviation
from quotegrid.operators.index import index_universe
from quotegrid.operators.quality import quality_gate
from quotegrid.plans import series
from quotegrid.plans.gold import index_rows


def quotes(spark, seed, n=160):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        month, price = rng.randint(1, 9), rng.choice([0.5, 0.5, 1.0, 1.25, 2.0, 7.5, None])
        rows.append(
            {
                "provider": rng.choice(["AWS", "Azure", "Other"]),
                "instance_type": f"i{rng.randint(0, 14)}",
                "tier": rng.choice(["Training", "Inference", "Unknown"]),
                "ingested_at": dt.datetime(2026, month, rng.randint(1, 28), i % 24),
                "price_per_hour": price,
                "region": rng.choice(["x", "y"]),
            }
        )
    return bronze(spark, *rows)


@pytest.mark.parametrize(("seed", "range_rows"), [(1, 1_024), (2, 1), (3, 4)])
def test_series_equals_a_run_per_month(spark, monkeypatch, seed, range_rows):
    monkeypatch.setattr(series, "RANGE_ROWS", range_rows)
    standing = series.standing_quotes(quotes(spark, seed))
    # A price that some rows lack, as for zero units.
    priced = F.when(F.col("instance_type") != "i3", F.col("price_per_hour"))
    clean = index_universe(quality_gate(standing)).withColumn("unit_price", priced)
    last = dt.date(2026, 11, 15)
    got = series.month_end_gold(clean, F.lit(last)).drop("index_timestamp")
    expected = []
    for month in range(1, 12):
        first = F.lit(dt.date(2026, month, 1))
        rows = index_rows(series.quotes_at(clean, first))
        expected += rows_of(rows.withColumn("index_date", F.last_day(first)))
    assert rows_of(got) == sorted(expected)


def test_no_row_per_key_and_month(spark):
    plan = series.month_end_gold(
        index_universe(quality_gate(series.standing_quotes(quotes(spark, 4)))).withColumn(
            "unit_price", F.col("price_per_hour")
        ),
        F.lit(dt.date(2026, 12, 1)),
    )
    text = plan._jdf.queryExecution().analyzed().toString()
    for line in text.splitlines():
        if "explode(sequence(" in line:
            assert "instance_type" not in line
    assert "Python" not in text


def test_a_quote_that_moves_to_another_tier(spark):
    df = bronze(
        spark,
        {"tier": "Training", "ingested_at": dt.datetime(2026, 1, 5)},
        {"tier": "Inference", "ingested_at": dt.datetime(2026, 3, 5)},
    ).withColumn("unit_price", F.col("price_per_hour"))
    got = series.month_end_gold(series.standing_quotes(df), F.lit(dt.date(2026, 4, 1)))
    seen = {(r.tier, r.index_date.month): r.sample_size for r in got.collect()}
    assert seen == {("Training", 1): 1, ("Training", 2): 1, ("Inference", 3): 1, ("Inference", 4): 1}


PRICES = st.lists(
    st.one_of(
        st.none(), st.just(float("nan")), st.floats(0, 1e3).map(lambda x: round(x, 4)),
        st.floats(1e9, 1e15), st.floats(-1e6, 1e6).map(lambda x: round(x, 2)),
    ),
    min_size=1, max_size=40,
)


@settings(max_examples=15, deadline=None)
@given(PRICES)
def test_deviation_does_not_depend_on_the_order(spark, prices):
    import math
    import statistics
    from fractions import Fraction

    df = spark.createDataFrame([(p,) for p in prices], "p double")
    found = {
        frame.agg(deviation("p").alias("d")).first().d
        for frame in (df.coalesce(1), df.repartition(3), df.orderBy(F.desc("p")), df.repartition(7, "p"))
    }
    counted = df.groupBy("p").agg(F.count("*").alias("n"))
    found.add(counted.agg(deviation("p", "n").alias("d")).first().d)
    assert len(found) == 1
    (got,) = found
    # As the operator does: steps of 1e-8.
    fine = [Fraction(math.floor(p)) + Fraction(round((p - math.floor(p)) * 1e8), 10**8)
            for p in prices if p is not None and p == p]
    if len(fine) < 2:
        assert got is None
    else:
        exact = math.sqrt(statistics.variance(fine))
        assert got == pytest.approx(exact, rel=1e-9, abs=1e-9)
