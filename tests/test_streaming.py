"""File stream, quarantine and the whole run."""

import datetime as dt
import json
import os

from helpers import rows_of
from pyspark.sql import functions as F

from quotegrid.operators.history import as_of
from quotegrid.operators.latest import latest_per_key
from quotegrid.plans.run import Paths, good_bronze, run
from quotegrid.plans.silver import advance_latest, build_silver
from quotegrid.schemas import BRONZE, CORRUPT, RESCUED
from quotegrid.session import CHECKPOINT_CONF, work_dir
from quotegrid.sources import tables
from quotegrid.streaming.bronze import drain, next_load, split_corrupt, stream_landing

ROW = {
    "provider": "AWS", "instance_type": "p3.2xlarge", "hw_type": "V100", "region": "us-east-1",
    "price_per_hour": 3.06, "price_type": "on_demand", "tier": "Fine-tuning",
}


def put(folder, name, *rows):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
    (folder / name).write_text("\n".join(lines))


def load(spark, tmp_path):
    out = f"{tmp_path}/bronze"
    drain(stream_landing(spark, f"{tmp_path}/raw"), out, f"{tmp_path}/checkpoint")
    return spark.read.schema(BRONZE).parquet(out)


def test_each_file_is_loaded_once(spark, tmp_path):
    put(tmp_path / "raw" / "aws", "1.json", ROW, {**ROW, "region": "x"})
    put(tmp_path / "raw" / "azure" / "deep", "1.json", {**ROW, "provider": "Azure"})
    assert load(spark, tmp_path).count() == 3
    assert load(spark, tmp_path).count() == 3
    put(tmp_path / "raw" / "aws", "2.json", {**ROW, "region": "y"})
    got = load(spark, tmp_path)
    assert got.count() == 4
    new = got.where("region = 'y'").first()
    assert new.source_file.endswith("/aws/2.json") and new.ingested_at is not None
    assert new.product_name is None


def test_landed_again_under_another_name(spark, tmp_path):
    put(tmp_path / "raw", "1.json", ROW)
    load(spark, tmp_path)
    put(tmp_path / "raw", "2.json", ROW)
    got = load(spark, tmp_path)
    assert got.count() == 2
    kept = latest_per_key(got).collect()
    assert len(kept) == 1 and kept[0].source_file.endswith("2.json")


def test_late_file_with_an_old_time(spark, tmp_path):
    put(tmp_path / "raw", "1.json", ROW)
    load(spark, tmp_path)
    put(tmp_path / "raw", "0.json", {**ROW, "region": "old"})
    then = (tmp_path / "raw" / "1.json").stat().st_mtime - 30 * 86400
    os.utime(tmp_path / "raw" / "0.json", (then, then))
    assert load(spark, tmp_path).count() == 2


def test_quarantine(spark, tmp_path):
    bad_price = json.dumps({**ROW, "price_per_hour": "high"})
    put(tmp_path / "raw", "1.json", ROW, '{"provider": "AWS"', bad_price, {**ROW, "more": 1})
    good, bad = split_corrupt(load(spark, tmp_path))
    assert good.count() == 2 and CORRUPT not in good.columns
    assert {r[CORRUPT] for r in bad.collect()} == {'{"provider": "AWS"', bad_price}


def catalogs(tmp_path, price):
    attributes = {
        "operatingSystem": "Linux", "tenancy": "Shared", "capacitystatus": "Used",
    }
    products, terms = [], []
    offers = (("1", "p3.8xlarge", 4), ("2", "g4dn.xlarge", 1), ("3", "inf1.xlarge", 1))
    for sku, instance, factor in offers:
        products.append({"sku": sku, "attributes": {"instanceType": instance, **attributes}})
        rate = {"pricePerUnit": {"USD": str(price * factor)}}
        terms.append({"sku": sku, "offers": {"o": {"priceDimensions": {"r": rate}}}})
    item = {
        "skuName": "NC4as_T4_v3", "unitPrice": price / 2, "serviceName": "Virtual Machines",
        "armRegionName": "eastus", "priceType": "Consumption",
    }
    put(tmp_path / "products", "1.json", *products)
    put(tmp_path / "terms", "1.json", *terms)
    put(tmp_path / "pages", "1.json", {"Items": [item]}, {"Items": []})


NAMES = ["products", "terms", "pages", "landing", "checkpoint", "bronze", "silver", "gold"]


def test_daily_run(spark, tmp_path):
    paths = Paths(**{n: f"{tmp_path}/{n}" for n in NAMES})
    catalogs(tmp_path, 2.0)
    run(spark, paths, as_of="2026-03-01 06:00:00")
    first = {r.tier: r for r in tables.read(spark, paths.gold).collect()}
    assert first.keys() == {"Fine-tuning", "Inference"}
    assert first["Fine-tuning"].index_median == 2.0
    inference = first["Inference"]
    assert (inference.aws_median, inference.azure_median) == (2.0, 1.0)
    assert (inference.provider_spread, inference.spread_pct) == (-1.0, -50.0)
    assert inference.best_value_provider == "Azure"
    assert inference.best_value_instance == "NC4as_T4_v3"

    catalogs(tmp_path, 3.0)
    run(spark, paths, as_of="2026-03-02 06:00:00")
    gold = tables.read(spark, paths.gold)
    assert gold.count() == 4
    assert tables.read(spark, paths.silver).count() == 4
    assert tables.read(spark, paths.bronze, BRONZE).count() == 8
    before = rows_of(gold.drop("index_timestamp"))
    run(spark, paths, as_of="2026-03-02 06:00:00", snapshot_mode="replace_date")
    assert rows_of(tables.read(spark, paths.gold).drop("index_timestamp")) == before


def test_incremental_run_equals_the_full_one(spark, tmp_path):
    names = {n: f"{tmp_path}/{n}" for n in NAMES}
    paths = Paths(**names, latest=f"{tmp_path}/latest")
    for price, day in ((2.0, "2026-03-01"), (3.0, "2026-03-02"), (2.5, "2026-03-03")):
        catalogs(tmp_path, price)
        run(spark, paths, as_of=day)
        rebuilt = build_silver(good_bronze(spark, paths), as_of=day)
        assert rows_of(tables.read(spark, paths.silver)) == rows_of(rebuilt)


def test_run_on_named_tables(spark, tmp_path):
    folders = {n: f"{tmp_path}/{n}" for n in NAMES[:5]}
    named = {n: f"quotegrid_run.{n}" for n in [*NAMES[5:], "latest"]}
    paths = Paths(**folders, **named)
    for price, day in ((2.0, "2026-03-01"), (3.0, "2026-03-02")):
        catalogs(tmp_path, price)
        run(spark, paths, as_of=day, snapshot_mode="replace_date")
    assert spark.table(paths.bronze).count() == 8
    assert spark.table(paths.silver).count() == 4
    gold = tables.read(spark, paths.gold).where("tier = 'Fine-tuning'")
    assert {r.index_date.day: r.index_median for r in gold.collect()} == {1: 2.0, 2: 3.0}
    spark.sql("DROP DATABASE quotegrid_run CASCADE")


def test_run_on_empty_catalogues(spark, tmp_path):
    paths = Paths(**{n: f"{tmp_path}/{n}" for n in NAMES})
    for name in ("products", "terms", "pages"):
        (tmp_path / name).mkdir()
    for _ in range(2):  # no landing folder yet, then an empty one
        checks = run(spark, paths, as_of="2026-03-01 06:00:00")
        assert checks["layers"].first().asDict() == dict.fromkeys(
            ("bronze_rows", "deduped_rows", "clean_rows"), 0
        )
    catalogs(tmp_path, 2.0)
    checks = run(spark, paths, as_of="2026-03-02 06:00:00")
    assert checks["layers"].first().bronze_rows == 4
    assert checks["bronze"].count() > 1 and checks["silver"].count() > 1


def test_currency_guard(spark, tmp_path):
    paths = Paths(**{n: f"{tmp_path}/{n}" for n in NAMES})
    catalogs(tmp_path, 2.0)
    checks = run(spark, paths, as_of="2026-03-01 06:00:00", currency="EUR")
    # Catalogue A states no currency, which counts as the wanted one.
    assert {r.provider for r in checks["bronze"].collect()} == {"AWS"}


def test_files_of_any_age_are_loaded(spark, tmp_path):
    put(tmp_path / "raw", "1.json", ROW)
    assert load(spark, tmp_path).count() == 1
    put(tmp_path / "raw", "0.json", {**ROW, "region": "epoch"})
    os.utime(tmp_path / "raw" / "0.json", (0, 0))
    assert load(spark, tmp_path).count() == 2


def test_unknown_fields_are_rescued(spark, tmp_path):
    put(tmp_path / "raw", "1.json", {**ROW, "more": 1, "deep": {"a": [1]}}, ROW)
    good, _ = split_corrupt(load(spark, tmp_path))
    kept = [r[RESCUED] for r in good.collect()]
    assert None in kept
    (extra,) = [json.loads(k) for k in kept if k]
    assert extra == {"more": "1", "deep": '{"a":[1]}'}


def test_loads_are_numbered_without_a_clock(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / n) for n in ("raw", "out", "checkpoint"))
    late, early = dt.datetime(2030, 1, 1), dt.datetime(2020, 1, 1)
    for n, (region, clock) in enumerate((("x", late), ("y", early)), 1):
        put(tmp_path / "raw", f"{n}.json", {**ROW, "region": region})
        assert next_load(spark, out) == n
        stream = stream_landing(spark, raw, load=n, loaded_at=clock)
        drain(stream, out, checkpoint)
        # The second clock runs behind the first one; its row is merged all the same.
        bronze = split_corrupt(spark.read.schema(BRONZE).parquet(out))[0]
        rows = advance_latest(bronze, str(tmp_path / "latest"))
        assert rows.count() == n


def test_as_of_in_another_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        rows = spark.sql("SELECT 'a' AS tier, timestamp'2026-03-02 01:00:00' AS index_timestamp")
        rows = rows.withColumn("index_date", F.to_date("index_timestamp"))
        tables.write_snapshot(rows, str(tmp_path / "gold"))
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        gold = spark.read.parquet(str(tmp_path / "gold"))
        assert as_of(gold, "2026-03-01 18:00:00").count() == 1
        assert as_of(gold, "2026-03-01 16:00:00").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_namespaces_of_two_parts(spark):
    tables.ensure_database(spark, "spark_catalog.quotegrid_parts")
    assert spark.catalog.databaseExists("quotegrid_parts")
    spark.sql("DROP DATABASE quotegrid_parts")


def test_work_dir_is_shared(spark):
    assert work_dir(spark, "a") != work_dir(spark, "a")
    assert work_dir(spark, "a").startswith(spark.conf.get(CHECKPOINT_CONF))

    class Unset:
        class conf:
            get = staticmethod(lambda key, *_: "/warehouse/" if "warehouse" in key else None)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    assert work_dir(Unset(), "a").startswith("/warehouse/_quotegrid/a-")


def test_command_line(spark, tmp_path, capsys):
    from quotegrid.__main__ import main

    catalogs(tmp_path, 2.0)
    args = [f"--{n}={tmp_path}/{n}" for n in NAMES]
    main([*args, "--as-of=2026-03-01 06:00:00", "--mode=replace_date"])
    shown = capsys.readouterr().out
    assert "Fine-tuning" in shown and "best_value_hw" in shown
