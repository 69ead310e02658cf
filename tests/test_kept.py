"""Kept tables: latest rows in parts, replacement, buckets, price summaries, inventories."""

import datetime as dt
import re

import pytest
from helpers import T0, T1, bronze, rows_of, silver
from pyspark.sql import functions as F

from quotegrid.operators import profile, sketches
from quotegrid.operators.index import index_universe
from quotegrid.operators.latest import latest_per_key
from quotegrid.operators.quantiles import QUARTILES
from quotegrid.plans import latest
from quotegrid.plans.gold import index_rows
from quotegrid.session import work_dir
from quotegrid.sources import catalogs, tables
from quotegrid.suite import queries


def loaded(spark, *rows):
    return bronze(spark, *({"instance_type": f"p3.{i}", "load": n, **more} for n, i, more in rows))


@pytest.mark.parametrize("named", [False, True])
def test_parts_equal_a_full_dedupe(spark, tmp_path, named):
    target = "quotegrid_parts_latest" if named else f"{tmp_path}/latest"
    rows = [(1, i, {"price_per_hour": float(i)}) for i in range(30)]
    rows += [(2, 3, {"price_per_hour": 9.0, "ingested_at": T1}), (2, 40, {"ingested_at": T1})]
    rows += [(3, 3, {"price_per_hour": 1.0, "ingested_at": T0}), (3, 4, {"ingested_at": T1})]
    df = loaded(spark, *rows)
    for load in (1, 2, 3):
        known = df.where(F.col("load") <= load)
        latest.advance_parts(known, target, parts=8)
        expected = latest_per_key(known.drop(*latest.RAW_ONLY))
        assert rows_of(latest.latest_rows(spark, target)) == rows_of(expected)
    assert latest.advance_parts(df, target, parts=8) == []
    # Two slots a part at most, one file each.
    files = [f for f in spark.read.table(target).inputFiles()] if named else spark.read.parquet(target).inputFiles()
    places = [re.search(r"_part=\d+/_slot=\d", f)[0] for f in files]
    assert len(set(places)) == len(places) <= 16
    if named:
        spark.sql(f"DROP TABLE {target}")
        spark.sql(f"DROP TABLE {target}_merged")


def test_untouched_parts_are_not_read(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/latest"
    df = loaded(spark, *[(1, i, {}) for i in range(60)])
    latest.advance_parts(df, target, parts=8)
    plans = []
    write = latest.overwrite_partitions
    monkeypatch.setattr(
        latest,
        "overwrite_partitions",
        lambda out, *a: plans.append(out._jdf.queryExecution().executedPlan().toString()) or write(out, *a),
    )
    before = set(spark.read.parquet(target).inputFiles())
    (touched,) = latest.advance_parts(loaded(spark, (2, 7, {"ingested_at": T1})), target, parts=8)
    assert re.search(rf"PartitionFilters: \[[^\]]*_part#\d+ (=|IN) \(?{touched}\)?", plans[0])
    (new,) = set(spark.read.parquet(target).inputFiles()) - before
    assert f"_part={touched}/" in new


def test_a_lost_version_leaves_the_part_as_it_was(spark, tmp_path, monkeypatch):
    target = f"{tmp_path}/latest"
    first = loaded(spark, *[(1, i, {}) for i in range(9)])
    latest.advance_parts(first, target, parts=2)
    kept = rows_of(latest.latest_rows(spark, target))

    def dies(*_):
        raise OSError("no space left")

    monkeypatch.setattr(latest, "overwrite_partitions", dies)
    more = first.unionByName(loaded(spark, (2, 50, {})))
    with pytest.raises(OSError):
        latest.advance_parts(more, target, parts=2)
    assert rows_of(latest.latest_rows(spark, target)) == kept
    monkeypatch.undo()
    latest.advance_parts(more, target, parts=2)
    assert latest.latest_rows(spark, target).count() == 10


def test_loads_share_one_join(spark, tmp_path, monkeypatch):
    rows = {
        "lineitem": (
            [(i % 5, i % 3, "FO"[i % 2], "RN"[i % 2], 100.0 + i, T0 + dt.timedelta(30 * i)) for i in range(40)],
            "l_partkey long, l_suppkey long, l_linestatus string, l_returnflag string,"
            " l_extendedprice double, l_shipdate timestamp",
        ),
        "part": ([(i, f"n{i}", f"Brand#{i}", "PROMO") for i in range(5)], "p_partkey long, p_name string, p_brand string, p_type string"),
        "supplier": ([(i, f"s{i}", i) for i in range(3)], "s_suppkey long, s_name string, s_nationkey long"),
        "nation": ([(i, f"land {i}") for i in range(3)], "n_nationkey long, n_name string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    plans, advance = [], queries.advance_parts
    monkeypatch.setattr(
        queries,
        "advance_parts",
        lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or advance(df, *a, **k),
    )
    got = queries.QUERIES["q55_partwise_latest"](spark, str(tmp_path))
    quotes = queries.b.quotes(spark, str(tmp_path)).withColumn("load", F.quarter("ingested_at"))
    assert rows_of(got) == rows_of(latest_per_key(quotes))
    assert len(plans) == 4 and not any("Join" in plan for plan in plans)


@pytest.mark.parametrize("named", [False, True])
def test_replacing_never_loses_the_old_rows(spark, tmp_path, named):
    target = "quotegrid_replaced" if named else f"{tmp_path}/table"
    tables.replace(spark.range(3), target)
    dies = F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id"))
    with pytest.raises(Exception, match="broken"):
        tables.replace(spark.range(9).select(dies.cast("bigint").alias("id")), target)
    assert tables.read(spark, target).count() == 3
    for n in (5, 6, 7):
        tables.replace(spark.range(n), target)
        assert tables.read(spark, target).count() == n
    # A table may be replaced by its own rows, and may get other columns.
    tables.replace(tables.read(spark, target).where("id < 2"), target)
    assert tables.read(spark, target).count() == 2
    tables.replace(spark.range(4).withColumn("more", F.lit(1)), target)
    assert tables.read(spark, target).columns == ["id", "more"]
    if named:
        spark.sql(f"DROP TABLE {target}")


def test_bucketed_catalogues_join_without_a_shuffle(spark):
    attributes = {"instanceType": "p3.2xlarge", "operatingSystem": "Linux", "tenancy": "Shared",
                  "capacitystatus": "Used"}
    products = spark.createDataFrame([(str(i), attributes) for i in range(40)], "sku string, attributes map<string,string>")
    offers = "map('o', named_struct('priceDimensions', map('r', named_struct('pricePerUnit', map('USD', sku)))))"
    terms = products.selectExpr("sku", f"{offers} AS offers")
    for name, df in (("quotegrid_b_products", products), ("quotegrid_b_terms", terms)):
        tables.write_bucketed(df, name, "sku", 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = catalogs.flatten_terms(spark.table("quotegrid_b_products"), spark.table("quotegrid_b_terms"), "x")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows.count() == 39
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in ("quotegrid_b_products", "quotegrid_b_terms"):
            spark.sql(f"DROP TABLE {name}")


def test_summaries_add_up_to_the_index(spark):
    rows = silver(
        spark,
        *[(t, p, f"i{n}", (n * 7 % 101) / 10, {"load": n % 5}) for t in "ab" for p in ("AWS", "Azure") for n in range(1, 200)],
        ("c", "AWS", "only", 2.0, {"load": 9}),
    )
    universe = index_universe(rows)
    kept = sketches.price_summaries(universe)
    assert kept.count() == 5 * 2 * 2 + 1
    got, exact = sketches.index_of_summaries(kept), index_rows(universe)
    # So few values that the sketches are exact but for the definition of a rank.
    plain = [c for c in exact.columns if not ("median" in c or "p25" in c or "p75" in c or "spread" in c)]
    assert rows_of(got.select(*plain)) == rows_of(exact.select(*plain))
    both = {r.tier: r for r in exact.collect()}
    for row in got.collect():
        for name in QUARTILES:
            assert abs(row[name] - both[row.tier][name]) <= 0.1
    assert sketches.rank_error(200) < 0.0134


def test_inventories_add_up(spark):
    df = bronze(spark, *({"load": n % 3, "source_file": f"f{n % 7}", "region": f"r{n % 2}", "ingested_at": (T0, T1)[n % 2]} for n in range(50)))
    kept = profile.load_inventory(df)
    assert rows_of(profile.inventory_of(kept)) == rows_of(profile.source_inventory(df))
    regions = profile.regions_of(profile.load_regions(df))
    assert rows_of(regions) == rows_of(profile.region_pages(df))


def test_work_dir_on_a_cluster():
    def session(master, home):
        class Fake:
            class conf:
                get = staticmethod(
                    lambda key, *_: {"spark.master": master, "spark.sql.warehouse.dir": home}.get(key)
                )

            class sparkContext:
                getCheckpointDir = staticmethod(lambda: None)

        return Fake

    with pytest.raises(ValueError, match="share"):
        work_dir(session("yarn", "/driver/disk"), "x")
    with pytest.raises(ValueError, match="share"):
        work_dir(session("local-cluster[2,1,512]", "file:/driver/disk"), "x")
    assert work_dir(session("yarn", "hdfs://store/wh"), "x").startswith("hdfs://store/wh/_quotegrid/x-")
    assert work_dir(session("local[4]", "/tmp/wh"), "x").startswith("/tmp/wh/")
