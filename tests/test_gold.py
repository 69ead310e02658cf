"""Index, spread, best value, derived figures."""

import datetime as dt
import random
import statistics

import pytest
from helpers import rows_of, silver
from pyspark.sql import functions as F

from quotegrid import schemas
from quotegrid.functions.scalars import percent_of
from quotegrid.operators import derived, index
from quotegrid.plans.gold import assemble_gold, build_gold, index_rows, stamp

NOW = "2026-03-03 06:00:00"


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_quartiles_are_observed_values(spark):
    df = silver(spark, *[("Training", "AWS", f"i{p}", float(p)) for p in (4, 1, 3, 2)])
    for approx in (False, True):
        row = one(index.tier_index(df, approx=approx))
        assert (row.index_p25, row.index_median, row.index_p75) == (1.0, 2.0, 3.0)
        assert (row.index_mean, row.index_stddev) == (2.5, round(statistics.stdev([1, 2, 3, 4]), 4))
        assert (row.price_floor, row.price_ceiling, row.sample_size) == (1.0, 4.0, 4)


def test_one_sample(spark):
    row = one(index.tier_index(silver(spark, ("Training", "AWS", "i", 2.5))))
    assert row.index_stddev is None
    assert row.price_floor == row.price_ceiling == row.index_median == 2.5


def test_spread(spark):
    df = silver(spark, ("Training", "AWS", "a", 2.0), ("Training", "Azure", "b", 1.5))
    for approx in (False, True):
        row = one(index_rows(df, approx=approx))
        assert (row.aws_median, row.azure_median) == (2.0, 1.5)
        assert (row.provider_spread, row.spread_pct) == (-0.5, -25.0)


def test_missing_provider_gives_nulls(spark):
    df = silver(spark, ("Training", "AWS", "a", 2.0), ("Training", "Other", "c", 9.0))
    for approx in (False, True):
        row = one(index_rows(df, approx=approx))
        assert (row.aws_median, row.azure_median) == (2.0, None)
        assert row.provider_spread is None and row.spread_pct is None
        assert row.sample_size == 2 and row.price_ceiling == 9.0


def test_zero_base_median_gives_no_percentage(spark):
    df = silver(spark, ("Training", "AWS", "a", 0.0), ("Training", "Azure", "b", 1.5))
    row = one(index_rows(df))
    assert (row.provider_spread, row.spread_pct) == (1.5, None)


def test_three_providers(spark):
    df = silver(spark, *[("Training", p, p, v) for p, v in (("A", 1.0), ("B", 2.0), ("C", 4.0))])
    row = one(index_rows(df, ["A", "B", "C"], base="B"))
    assert (row.a_spread, row.a_spread_pct, row.c_spread, row.c_spread_pct) == (-1, -50, 2, 100)


def test_universe(spark):
    df = silver(
        spark,
        ("Training", "AWS", "a", 1.0),
        ("Training", "AWS", "b", 0.1, {"price_type": "spot"}),
        ("Edge", "AWS", "c", 0.2),
        (None, "AWS", "d", 0.3),
    )
    assert [r.instance_type for r in index.index_universe(df).collect()] == ["a"]
    edge = index.index_universe(df, exclude_tiers=("Training",))
    assert [r.instance_type for r in edge.collect()] == ["c"]


def test_best_value_tie(spark):
    rows = [
        ("Training", p, i, 1.0, {"region": r, "hw_type": None})
        for p in ("Azure", "AWS")
        for i in ("b", "a")
        for r in ("y", "x")
    ]
    for order in (rows, rows[::-1]):
        df = silver(spark, *order).repartition(3)
        picks = [one(index.best_value(df))]
        picks += [one(index_rows(df, approx=a)) for a in (False, True)]
        for row in picks:
            assert (row.best_value_provider, row.best_value_instance) == ("AWS", "a")
            assert (row.best_value_region, row.best_value_unit_price) == ("x", 1.0)


def test_best_value_of_distant_groups(spark):
    nan = float("nan")
    df = silver(
        spark,
        *[("T", "AWS", f"t{p}", p) for p in (500.0, 700.0)],
        *[("F", "AWS", f"f{p}", p) for p in (0.5, 0.7)],
        ("N", "AWS", "null", None),
        ("M", "AWS", "m1", None),
        ("M", "AWS", "m2", 0.1),
    )
    picks = {r.tier: r.best_value_instance for r in index.best_value(df).collect()}
    assert picks == {"T": "t500.0", "F": "f0.5", "N": "null", "M": "m2"}
    odd = silver(spark, ("A", "AWS", "a", nan), ("B", "AWS", "b", 1.0), ("B", "AWS", "c", nan))
    picks = {r.tier: r.best_value_instance for r in index.best_value(odd).collect()}
    assert picks == {"A": "a", "B": "b"}


def random_quotes(spark, n=600):
    rng = random.Random(11)
    rows = [
        (
            rng.choice(["Training", "Fine-tuning", "Inference", "Edge"]),
            rng.choice(["AWS", "Azure", "Other"]),
            f"i{rng.randrange(40)}",
            round(rng.lognormvariate(1, 1), 4),
            {"price_type": rng.choice(["on_demand", "on_demand", "spot"])},
        )
        for _ in range(n)
    ]
    return silver(spark, *rows)


def test_all_forms_of_gold_agree(spark):
    df = random_quotes(spark)
    universe = index.index_universe(df)
    spread = index.provider_spread(index.provider_summary(universe), ["AWS", "Azure"])
    joined = assemble_gold(index.tier_index(universe), spread, index.best_value(universe))
    expected = rows_of(joined)
    assert len(expected) == 3
    assert rows_of(index_rows(universe)) == expected
    assert rows_of(index_rows(universe, approx=True)) == expected
    for parts in (1, 9):
        assert rows_of(index_rows(universe.repartition(parts))) == expected
    summary = index.provider_summary(universe, approx=True)
    assert rows_of(summary) == rows_of(index.provider_summary(universe))


def test_null_keys_are_groups(spark):
    df = silver(spark, (None, None, "a", 1.0), (None, None, "b", 3.0), ("T", "AWS", "c", 2.0))
    medians = {r.tier: r.index_median for r in index.tier_index(df).collect()}
    assert medians == {None: 1.0, "T": 2.0}
    summary = index.provider_summary(df)
    assert rows_of(summary) == rows_of(index.provider_summary(df, approx=True))
    assert rows_of(index_rows(df)) == rows_of(index_rows(df, approx=True))


def test_invariants(spark):
    df = random_quotes(spark)
    gold = build_gold(df, as_of=NOW)
    rows = gold.collect()
    universe = index.index_universe(df)
    prices = {r.unit_price for r in universe.collect()}
    for r in rows:
        assert r.price_floor <= r.index_p25 <= r.index_median <= r.index_p75 <= r.price_ceiling
        assert r.index_median in prices and r.best_value_unit_price == r.price_floor
        assert r.index_date == dt.date(2026, 3, 3) and r.run_id == "20260303_060000"
        assert r.index_timestamp == dt.datetime(2026, 3, 3, 6)
    assert sum(r.sample_size for r in rows) == universe.count()
    wanted = {f.name: f.dataType for f in schemas.gold(["AWS", "Azure"])}
    assert {f.name: f.dataType for f in gold.schema} == wanted


def test_mean_does_not_depend_on_the_order(spark):
    # The exact mean ends on a half; summing doubles gives either neighbour.
    prices = [47705.5731, 47705.5732] * 50 + [0.1, 0.2, 0.3, 0.4]
    expected = None
    for seed in range(3):
        random.Random(seed).shuffle(prices)
        df = silver(spark, *[("T", "AWS", "i", p) for p in prices]).repartition(seed + 1)
        mean = one(index.tier_index(df)).index_mean
        expected = expected or mean
        assert mean == expected


def test_empty_universe(spark):
    df = silver(spark, ("Edge", "AWS", "c", 0.2))
    assert build_gold(df, as_of=NOW).isEmpty()


@pytest.mark.parametrize(
    "a,b,shown",
    # Published medians are rounded to cents, so the percentage may be off by one.
    [(2.04, 1.60, -21), (2.56, 0.75, -71), (6.88, 4.10, -40)],
)
def test_published_spreads(spark, a, b, shown):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    got = df.select(percent_of(F.col("b") - F.col("a"), F.col("a"), 0)).first()[0]
    assert abs(got - shown) <= 1


def test_published_dispersion_and_premium(spark):
    rows = [("Fine-tuning", 2.04, 1.19), ("Inference", 2.18, 5.46), ("Training", 4.10, 17.02)]
    gold = stamp(
        spark.createDataFrame(rows, "tier string, index_median double, index_stddev double"), NOW
    ).withColumns({"index_p25": F.lit(1.0), "index_p75": F.lit(1.5)})
    got = {r.tier: (r.stddev_pct, r.iqr) for r in derived.dispersion(gold).collect()}
    assert got == {"Fine-tuning": (58, 0.5), "Inference": (250, 0.5), "Training": (415, 0.5)}
    premium = {r.tier: r.premium for r in derived.tier_premium(gold, "Inference").collect()}
    assert premium == {"Fine-tuning": 0.94, "Inference": 1.0, "Training": 1.88}
    assert {r.premium for r in derived.tier_premium(gold, "Edge").collect()} == {None}
