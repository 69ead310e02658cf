"""Dedupe, quality gate, unit normalisation."""

import datetime as dt
import itertools

import pytest
from helpers import T0, T1, bronze, rows_of
from pyspark.sql import functions as F

from quotegrid.functions.scalars import mean
from quotegrid.operators.latest import QUOTE_KEYS, latest_per_key, refresh_latest
from quotegrid.operators.profile import counted, layer_counts, source_inventory, tier_summary
from quotegrid.operators.quality import one_currency, quality_gate, quality_rejects
from quotegrid.operators.units import lookup, normalise_units, perf_adjust
from quotegrid.plans.silver import build_silver, current_quotes
from quotegrid.schemas import PERF_COLUMNS, SILVER

NAN = float("nan")


def test_newest_row_wins(spark):
    df = bronze(
        spark,
        {"price_per_hour": 1.0},
        {"price_per_hour": 9.0, "ingested_at": T1},
        {"price_per_hour": 0.5, "ingested_at": None},
        {"price_per_hour": 2.0, "price_type": "spot"},
    )
    got = {(r.price_type, r.price_per_hour) for r in latest_per_key(df).collect()}
    assert got == {("on_demand", 9.0), ("spot", 2.0)}


def test_ties_do_not_depend_on_the_layout(spark):
    tied = [
        {"price_per_hour": p, "product_name": n, "source_file": f}
        for p, n, f in itertools.product([None, 2.0, 1.0], ["b", None, "a"], ["x", "y"])
    ]
    expected = None
    for order, parts in ((tied, 1), (tied[::-1], 5), (tied[7:] + tied[:7], 13)):
        row = latest_per_key(bronze(spark, *order).repartition(parts)).collect()
        assert len(row) == 1
        expected = expected or row
        assert row == expected
    assert (expected[0].price_per_hour, expected[0].product_name) == (1.0, "a")


def test_newest_bad_row_hides_its_key(spark):
    df = bronze(
        spark, {"price_per_hour": 1.0}, {"price_per_hour": None, "ingested_at": T1}
    )
    assert current_quotes(df).isEmpty()
    assert current_quotes(df, filter_first=True).first().price_per_hour == 1.0


def test_gate_and_rejects_split_the_rows(spark):
    cases = [
        ({"price_per_hour": None}, "price missing"),
        ({"price_per_hour": NAN}, "price not a number"),
        ({"price_per_hour": 0.0}, "price not positive"),
        ({"price_per_hour": -1.0}, "price not positive"),
        ({"tier": None}, "tier missing"),
        ({"tier": "Unknown"}, "tier unknown"),
        ({"hw_type": None}, "hardware missing"),
        ({"hw_type": "unknown"}, None),
        ({}, None),
    ]
    df = bronze(spark, *[{**c, "source_file": str(i)} for i, (c, _) in enumerate(cases)])
    reasons = {int(r.source_file): r.reject_reason for r in quality_rejects(df).collect()}
    assert reasons == {i: why for i, (_, why) in enumerate(cases) if why}
    kept = {int(r.source_file) for r in quality_gate(df).collect()}
    assert kept == {i for i, (_, why) in enumerate(cases) if not why}


@pytest.mark.parametrize(
    "instance,price,count,known,unit",
    [
        ("p3.8xlarge", 12.24, 4, True, 3.06),
        ("Standard_NC12s_v3", 6.12, 2, True, 3.06),
        ("g6e.12xlarge", 10.0, 1, False, 10.0),
        ("P3.8xlarge", 12.24, 1, False, 12.24),
        ("NC4as_T4_v3 Spot", 1.0, 1, False, 1.0),
        ("p3.2xlarge", 1.00005, 1, True, 1.0001),
    ],
)
def test_units(spark, instance, price, count, known, unit):
    row = normalise_units(
        bronze(spark, {"instance_type": instance, "price_per_hour": price})
    ).first()
    assert (row.unit_count, row.unit_count_known, row.unit_price) == (count, known, unit)
    assert row.instance_type == instance


def test_zero_units_give_no_price(spark):
    row = normalise_units(bronze(spark, {}), {"p3.2xlarge": 0}).first()
    assert row.unit_count == 0 and row.unit_price is None


def test_large_lookup_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("quotegrid.operators.units.BROADCAST_BYTES", 1)
    df = normalise_units(bronze(spark, {}), {"p3.2xlarge": 2, "x": 1})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert df.first().unit_count == 2


def test_ties_are_broken_by_maps_too(spark):
    rows = spark.sql(
        "SELECT 'k' AS k, 1 AS t, map('a', v) AS m FROM VALUES ('2'), ('1') AS x(v)"
    ).repartition(2)
    assert latest_per_key(rows, ["k"], ts="t").first().m == {"a": "1"}


def test_lookups_as_tables(spark):
    units = spark.createDataFrame([("p3.2xlarge", 2)], "name string, n int")
    df = normalise_units(bronze(spark, {}, {"instance_type": "x"}), units)
    assert {r.instance_type: r.unit_count for r in df.collect()} == {"p3.2xlarge": 2, "x": 1}
    weights = spark.createDataFrame([("V100", 0.5), ("unknown", 0.1)], "hw string, w double")
    rows = perf_adjust(
        bronze(spark, {}, {"hw_type": "H100"}).withColumn("unit_price", F.lit(1.0)), weights
    )
    assert {r.hw_type: r.perf_index for r in rows.collect()} == {"V100": 0.5, "H100": 0.1}


def test_infinite_and_huge_prices_are_rejected(spark):
    rows = bronze(spark, *({"price_per_hour": p} for p in (float("inf"), 1e17, 2.0)))
    assert [r.price_per_hour for r in quality_gate(rows).collect()] == [2.0]
    assert {r.reject_reason for r in quality_rejects(rows).collect()} == {"price out of range"}
    got = rows.agg(mean("price_per_hour").alias("m")).first().m
    assert got == 2.0


def test_perf_weights(spark):
    df = bronze(spark, {"hw_type": "V100"}, {"hw_type": "H100"}).withColumn(
        "unit_price", F.lit(0.9)
    )
    got = {r.hw_type: (r.perf_index, r.price_per_perf_unit) for r in perf_adjust(df).collect()}
    assert got == {"V100": (0.45, 2.0), "H100": (0.25, 3.6)}


def test_silver_schema_and_key(spark):
    df = bronze(spark, {}, {"price_per_hour": 2.0}, {"region": "x", "currency": "USD"})
    got = build_silver(df, as_of="2026-03-03 06:00:00")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in SILVER]
    assert got.count() == got.select(*QUOTE_KEYS).distinct().count() == 2
    assert got.first().transformed_at == dt.datetime(2026, 3, 3, 6)
    weighted = build_silver(df, weights={"V100": 0.5, "unknown": 0.1})
    assert weighted.columns == [*SILVER.names, *PERF_COLUMNS.names]


def test_refreshing_equals_rebuilding(spark):
    rows = [
        {"instance_type": f"p3.{i % 7}", "price_per_hour": float(i % 5), "ingested_at": t}
        for i, t in itertools.product(range(40), (T0, T1))
    ]
    df = bronze(spark, *rows)
    old, new = df.where(F.col("ingested_at") == T0), df.where(F.col("ingested_at") == T1)
    refreshed = refresh_latest(latest_per_key(old), new)
    assert rows_of(refreshed) == rows_of(latest_per_key(df))


def test_counts(spark):
    df = bronze(spark, {}, {"price_per_hour": 2.0}, {"tier": "Unknown", "region": "x"})
    assert tuple(layer_counts(df).first()) == (3, 2, 1)
    assert tuple(layer_counts(df.limit(0)).first()) == (0, 0, 0)
    seen, observation = counted(df, "bronze")
    seen.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 3}
    inventory = source_inventory(df).first()
    assert (inventory.source_file, inventory.n, inventory.first_ingested_at) == ("f1", 3, T0)


def test_summary_averages(spark):
    df = normalise_units(
        bronze(
            spark,
            {"price_per_hour": 1.0, "instance_type": "p3.8xlarge"},
            {"price_per_hour": 2.0},
            {"price_per_hour": 50.0, "price_type": "spot"},
        )
    )
    row = tier_summary(df).first()
    assert tuple(row) == ("Fine-tuning", 1.5, 1.125, 2)
    assert "avg_perf_price" in tier_summary(perf_adjust(df)).columns


def test_lookup_and_currency(spark):
    from pyspark.sql import types as T

    dim = lookup(spark, {"a": 1}, "k", "v", T.LongType())
    assert dim.collect() == [("a", 1)]
    df = bronze(spark, {"currency": "USD"}, {"currency": None}, {"currency": "EUR"})
    assert one_currency(df).count() == 2
