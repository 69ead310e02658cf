"""Columns that turn up later, counts of a load, payloads without a schema."""

import json

import pytest
from helpers import bronze
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid.functions.variants import column_kind, inferred
from quotegrid.plans.run import Paths, good_bronze, grown_bronze, load_landing
from quotegrid.schemas import BRONZE, LOAD
from quotegrid.sources import catalogs, tables
from quotegrid.streaming.bronze import load_counts, split_corrupt
from quotegrid.streaming.growth import grow, promoted_columns, rescued_types

ROW = {"provider": "AWS", "instance_type": "p3.2xlarge", "price_per_hour": 3.06}


@pytest.fixture
def paths(tmp_path):
    names = ["products", "terms", "pages", "landing", "checkpoint", "bronze", "silver", "gold"]
    return Paths(**{n: f"{tmp_path}/{n}" for n in names})


def put(tmp_path, name, *rows):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
    (folder / name).write_text("\n".join(lines))


def test_new_fields_become_typed_columns(spark, tmp_path, paths):
    put(tmp_path, "1.json", {**ROW, "region": "one"})
    assert load_landing(spark, paths) == 1
    fields = {"n": 5, "x": 1.5, "t": "hey", "ok": True, "deep": {"a": [1]}, "value": 2, "none": None}
    put(tmp_path, "2.json", {**ROW, "region": "two", **fields, "PROVIDER": "clash"})
    assert load_landing(spark, paths) == 2
    kinds = {f.name: f.dataType.simpleString() for f in promoted_columns(spark, f"{paths.bronze}_versions")}
    assert kinds == {
        "deep": "string", "n": "bigint", "ok": "boolean", "t": "string", "value": "bigint",
        "x": "double",
    }
    put(tmp_path, "3.json", {**ROW, "region": "fits", **fields}, {**ROW, "region": "odd", "n": "high", "x": "7"})
    assert load_landing(spark, paths) == 3
    rows = {r.region: r for r in grown_bronze(spark, paths).collect()}
    assert (rows["fits"].n, rows["fits"].x, rows["fits"].t, rows["fits"].ok) == (5, 1.5, "hey", True)
    assert (rows["fits"].deep, rows["fits"].value) == ('{"a":[1]}', 2)
    assert rows["two"].n is None and json.loads(rows["two"]["_rescued_data"])["n"] == "5"
    assert rows["odd"].n is None and rows["odd"].x == 7.0
    assert json.loads(rows["odd"]["_rescued_data"]) == {"n": "high"}
    assert rows["one"]["_rescued_data"] is None and rows["one"].t is None
    # Silver's columns are the declared ones, whatever turned up.
    assert good_bronze(spark, paths).columns == [c for c in BRONZE.names if c != "_corrupt_record"]


def test_growth_of_a_named_table(spark, tmp_path, paths):
    from dataclasses import replace

    named = replace(paths, bronze="quotegrid_growth.bronze")
    tables.ensure_database(spark, "quotegrid_growth")
    for n in (1, 2):
        put(tmp_path, f"{n}.json", {**ROW, "more": n})
        load_landing(spark, named)
    rows = {r[LOAD]: r.more for r in spark.table(named.bronze).collect()}
    assert rows == {1: None, 2: 2}
    spark.sql("DROP DATABASE quotegrid_growth CASCADE")


def test_a_version_that_was_lost_comes_with_the_next_look(spark, tmp_path):
    rows = [{LOAD: 1, "_rescued_data": '{"a":"1"}'}, {LOAD: 2, "_rescued_data": '{"b":"x"}'}]
    schema = T.StructType(BRONZE.fields)
    df = spark.createDataFrame([[r.get(n) for n in schema.names] for r in rows], schema)
    versions = f"{tmp_path}/versions"
    # The run of load 1 died before it looked; the next look takes both loads.
    assert grow(spark, df, versions).names == ["a", "b"]
    assert grow(spark, df, versions).names == ["a", "b"]
    assert tables.read(spark, versions).count() == 2


def test_types_of_rescued_fields(spark):
    texts = ['{"a":"1","b":"x"}', '{"a":"2.5","c":"[1]"}', '{"d":"007","e":"12345678901234567890"}', None]
    df = spark.createDataFrame([(t,) for t in texts], "_rescued_data string")
    kinds = {n: k.simpleString() for n, k in rescued_types(df).items()}
    assert kinds == {"a": "double", "b": "string", "c": "string", "d": "string", "e": "decimal(38,0)"}
    assert rescued_types(df.limit(0)) == {}


def test_kinds():
    assert column_kind(inferred("VOID")) is None
    assert column_kind(inferred("DECIMAL(3,1)")) == T.DoubleType()
    assert column_kind(inferred("OBJECT<a: BIGINT>")) == T.StringType()


def test_counts_of_a_load(spark, tmp_path, paths):
    put(tmp_path, "1.json", ROW, {**ROW, "more": 1}, '{"broken')
    load_landing(spark, paths)
    put(tmp_path, "2.json", ROW)
    load_landing(spark, paths)
    load_landing(spark, paths)  # nothing new: no load
    loads = f"{paths.bronze}_loads"
    counts = {r[LOAD]: tuple(r)[1:] for r in load_counts(spark, loads, paths.bronze).collect()}
    assert counts == {1: (2, 1, 1), 2: (1, 0, 0)}
    assert tables.read(spark, loads).count() == 2
    # A run that died before it noted its load is made up for from that load's folder.
    again = load_counts(spark, f"{tmp_path}/none", paths.bronze)
    assert {r[LOAD]: tuple(r)[1:] for r in again.collect()} == counts
    good, bad = split_corrupt(grown_bronze(spark, paths))
    assert (good.count(), bad.count()) == (3, 1)


def test_archive_takes_loaded_files(spark, tmp_path, paths):
    from dataclasses import replace

    moved = replace(paths, archive=f"{tmp_path}/archive")
    for n in (1, 2, 3):
        put(tmp_path, f"{n}.json", {**ROW, "region": str(n)})
        load_landing(spark, moved)
    assert good_bronze(spark, moved).count() == 3
    assert list((tmp_path / "archive").rglob("*.json"))


def test_payload_fields_are_found(spark):
    texts = ['{"a":1,"n":{"x y":2.5,"q":null}}', '{"a":"7","b":true}', "no json", None]
    df = bronze(spark, *({"raw_payload": t, "region": str(i)} for i, t in enumerate(texts)))
    kinds = {p: k.simpleString() for p, k in catalogs.payload_fields(df).items()}
    assert kinds == {
        "$['a']": "string", "$['b']": "boolean", "$['n']['q']": "string", "$['n']['x y']": "double",
    }
    wanted = {"a": ("$['a']", T.LongType()), "x": ("$['n']['x y']", T.DoubleType())}
    rows = {r.region: r for r in catalogs.with_payload_fields(df, wanted).collect()}
    assert [rows[str(i)].a for i in range(4)] == [1, 7, None, None]
    assert [rows[str(i)].x for i in range(4)] == [2.5, None, None, None]
    assert catalogs.payload_fields(df.where(F.lit(False))) == {}
