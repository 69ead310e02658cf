"""Snapshots, reads of the past, reports, replayed series."""

import datetime as dt

import pytest
from helpers import bronze, rows_of, silver
from pyspark.sql import functions as F

from quotegrid.operators.history import as_of, latest_as_of, latest_snapshot, version_as_of
from quotegrid.operators.index import index_universe, tier_index
from quotegrid.operators.latest import latest_per_key
from quotegrid.plans.gold import build_gold
from quotegrid.plans.reports import best_value_report, index_report
from quotegrid.plans.series import month_end_index, month_end_quotes
from quotegrid.sources import tables

DAY1, DAY2, DAY3 = ("2026-03-01 06:00:00", "2026-03-02 06:00:00", "2026-03-03 06:00:00")


def snapshot(spark, when, price):
    rows = silver(spark, ("Training", "AWS", "a", price), ("Inference", "Azure", "b", price / 2))
    return build_gold(rows, as_of=when)


def history(spark, folder, *days):
    for when, price in days:
        tables.write_snapshot(snapshot(spark, when, price), folder)
    return tables.read(spark, folder, merge=True)


def test_reads_of_the_past(spark, tmp_path):
    gold = history(spark, f"{tmp_path}/gold", (DAY1, 1.0), (DAY2, 2.0), (DAY3, 3.0))
    assert gold.count() == 6
    assert as_of(gold, "2026-03-02 05:59:59").count() == 2
    assert as_of(gold, DAY2).count() == 4
    assert as_of(gold, dt.datetime(2026, 3, 2, 6)).count() == 4
    assert as_of(gold, "2026-02-01").isEmpty()
    assert {r.tier: r.index_median for r in latest_as_of(gold, DAY2).collect()} == {
        "Training": 2.0,
        "Inference": 1.0,
    }
    newest = {r.tier: r.index_median for r in latest_snapshot(gold).collect()}
    assert newest == {"Training": 3.0, "Inference": 1.5}
    for n in range(4):
        assert version_as_of(gold, n).count() == 2 * min(n + 1, 3)
    assert version_as_of(gold, 1).columns == gold.columns


def test_as_of_skips_later_folders(spark, tmp_path):
    gold = history(spark, f"{tmp_path}/gold", (DAY1, 1.0), (DAY3, 3.0))
    plan = as_of(gold, DAY2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(index_date" in plan


def test_snapshot_modes(spark, tmp_path):
    first, again = snapshot(spark, DAY1, 1.0), snapshot(spark, DAY1, 5.0)
    other = snapshot(spark, DAY2, 2.0)
    for mode, rows in (("append", 6), ("replace_date", 4)):
        folder = f"{tmp_path}/{mode}"
        for df in (first, other, again):
            tables.write_snapshot(df, folder, mode)
        got = tables.read(spark, folder, merge=True)
        assert got.count() == rows
        day1 = got.where("index_date = '2026-03-01' and tier = 'Training'")
        assert max(r.index_median for r in day1.collect()) == 5.0
    with pytest.raises(ValueError):
        tables.write_snapshot(first, f"{tmp_path}/x", "merge")


def test_snapshot_tables_by_name(spark):
    tables.ensure_database(spark, "quotegrid_test")
    name = "quotegrid_test.gold"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for when, price in ((DAY1, 1.0), (DAY2, 2.0), (DAY1, 5.0)):
        tables.write_snapshot(snapshot(spark, when, price), name, "replace_date")
    got = tables.read(spark, name)
    assert got.count() == 4
    assert as_of(got, DAY1).where("tier = 'Training'").first().index_median == 5.0
    tables.write_snapshot(snapshot(spark, DAY2, 7.0), name)
    assert tables.read(spark, name).count() == 6
    tables.overwrite(snapshot(spark, DAY3, 1.0), "quotegrid_test.silver")
    tables.overwrite(snapshot(spark, DAY3, 1.0).select("tier"), "quotegrid_test.silver")
    assert tables.read(spark, "quotegrid_test.silver").columns == ["tier"]
    spark.sql("DROP DATABASE quotegrid_test CASCADE")


def test_a_broken_write_leaves_the_kept_state(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/state"
    assert tables.read_kept(spark, target) is None
    for n in (1, 2, 3):
        before = tables.read_kept(spark, target)
        rows = spark.range(n) if before is None else before.union(spark.range(1))
        assert tables.keep(rows, target).count() == n
    overwrite = tables.overwrite

    def dies(df, place):
        overwrite(df.limit(1), place)
        raise OSError("lost")

    monkeypatch.setattr(tables, "overwrite", dies)
    with pytest.raises(OSError):
        tables.keep(spark.range(9), target)
    assert tables.read_kept(spark, target).count() == 3


def test_late_columns_are_seen(spark, tmp_path):
    gold = snapshot(spark, DAY1, 1.0)
    tables.write_snapshot(gold, f"{tmp_path}/g")
    tables.write_snapshot(
        snapshot(spark, DAY2, 1.0).withColumn("extra", F.lit(1)), f"{tmp_path}/g"
    )
    assert "extra" in tables.read(spark, f"{tmp_path}/g", merge=True).columns


def test_reports(spark, tmp_path):
    gold = history(spark, f"{tmp_path}/gold", (DAY1, 1.0), (DAY2, 2.0))
    report = index_report(gold).collect()
    assert [(r.tier, r.index_median) for r in report] == [("Inference", 1.0), ("Training", 2.0)]
    best = best_value_report(gold).collect()
    assert [(r.tier, r.best_value_provider, r.best_value_price) for r in best] == [
        ("Inference", "Azure", 1.0),
        ("Training", "AWS", 2.0),
    ]


def test_month_ends_equal_a_run_per_month(spark):
    def at(month, day=1):
        return dt.datetime(2026, month, day)

    df = bronze(
        spark,
        {"instance_type": "a", "ingested_at": at(1, 5), "price_per_hour": 1.0},
        {"instance_type": "a", "ingested_at": at(1, 20), "price_per_hour": 2.0},
        {"instance_type": "a", "ingested_at": at(4, 2), "price_per_hour": 3.0},
        {"instance_type": "b", "ingested_at": at(2, 28), "price_per_hour": 9.0},
        {"instance_type": "c", "ingested_at": at(5, 31), "price_per_hour": 4.0},
    )
    got = month_end_quotes(df)
    for month in range(1, 6):
        known = latest_per_key(df.where(F.col("ingested_at") < at(month + 1)))
        then = got.where(F.col("index_month") == at(month)).drop("index_month")
        assert rows_of(then) == rows_of(known), month
    assert got.select("index_month").distinct().count() == 5

    priced = index_universe(got).withColumn("unit_price", F.col("price_per_hour"))
    series = month_end_index(priced, lambda rows, keys: tier_index(rows, keys))
    sizes = {r.index_date: r.sample_size for r in series.collect()}
    assert sizes == {
        dt.date(2026, 1, 31): 1,
        dt.date(2026, 2, 28): 2,
        dt.date(2026, 3, 31): 2,
        dt.date(2026, 4, 30): 2,
        dt.date(2026, 5, 31): 3,
    }
