"""Catalogue flatteners on hand-written JSON, and the landing sink."""

import json

import pytest

from quotegrid import schemas
from quotegrid.sources.catalogs import (
    ambiguous_terms,
    flatten_pages,
    flatten_terms,
    reparse,
    union_providers,
)
from quotegrid.sources.landing import discover_schema, land

GOOD = {
    "instanceType": "p3.2xlarge",
    "operatingSystem": "Linux",
    "tenancy": "Shared",
    "capacitystatus": "Used",
    "gpuMemory": "16 GB",
    "vcpu": "8",
    "memory": "61 GiB",
}


def product(sku, **changes):
    attributes = {k: v for k, v in {**GOOD, **changes}.items() if v is not None}
    return {"sku": sku, "attributes": attributes}


def term(sku, *offers):
    """Each offer is a list of pricePerUnit maps, or None for an offer without rates."""
    body = {}
    for i, rates in enumerate(offers):
        rates = rates and {f"r{9 - j}": {"pricePerUnit": p} for j, p in enumerate(rates)}
        body[f"o{9 - i}"] = {"priceDimensions": rates} if rates else {}
    return {"sku": sku, "offers": body}


def frames(spark, tmp_path, products, terms):
    for name, rows in (("products", products), ("terms", terms)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part.json").write_text("\n".join(json.dumps(r) for r in rows))
    return (
        spark.read.schema(schemas.CATALOG_A_PRODUCTS).json(str(tmp_path / "products")),
        spark.read.schema(schemas.CATALOG_A_TERMS).json(str(tmp_path / "terms")),
    )


def test_products_and_terms(spark, tmp_path):
    usd = {"USD": "3.06"}
    products = [
        product("ok"),
        product("windows", operatingSystem="Windows"),
        product("dedicated", tenancy="Dedicated"),
        product("unused", capacitystatus="AllocatedHost"),
        product("no-os", operatingSystem=None),
        product("other", instanceType="m5.large"),
        product("no-terms"),
        product("zero"),
        product("euro-last"),
        product("text"),
        product("last-wins", gpuMemory=None),
        product("empty-offer-last"),
        product("rate-without-prices"),
        product("negative"),
    ]
    terms = [
        *[term(s, [usd]) for s in ("ok", "windows", "dedicated", "unused", "no-os", "other")],
        term("zero", [{"USD": "0"}]),
        term("euro-last", [{"USD": "1"}, {"EUR": "2"}]),
        term("text", [{"USD": "n/a"}]),
        term("last-wins", [{"USD": "5"}], [{"USD": "1.0"}, {"USD": "2.0"}]),
        term("empty-offer-last", [{"USD": "7"}], None),
        term("rate-without-prices", [{"USD": "7"}, None]),
        term("negative", [{"USD": "-1"}]),
        term("without-product", [usd]),
    ]
    p, t = frames(spark, tmp_path, products, terms)
    got = flatten_terms(p, t, "us-east-1")
    rows = {(r.price_per_hour, r.unit_text) for r in got.collect()}
    assert rows == {(3.06, "16 GB"), (2.0, "unknown"), (7.0, "16 GB"), (-1.0, "16 GB")}
    first = got.where("price_per_hour = 3.06").first().asDict()
    payload = json.loads(first.pop("raw_payload"))
    assert payload == GOOD
    assert first == {
        "provider": "AWS", "instance_type": "p3.2xlarge", "hw_type": "V100",
        "unit_text": "16 GB", "vcpu": "8", "memory_gb": "61 GiB", "region": "us-east-1",
        "price_per_hour": 3.06, "price_type": "on_demand", "tier": "Fine-tuning",
    }
    assert {r.sku: r.rates for r in ambiguous_terms(t).collect()} == {
        "euro-last": 2,
        "last-wins": 3,
        "rate-without-prices": 2,
    }


ITEM = {
    "skuName": "NC4as_T4_v3",
    "productName": "NCasT4_v3 Series",
    "unitPrice": 0.526,
    "currencyCode": "USD",
    "serviceName": "Virtual Machines",
    "armRegionName": "eastus",
    "priceType": "Consumption",
}


def pages(spark, tmp_path, *page_items):
    path = tmp_path / "pages.json"
    lines = [{} if items is None else {"Items": items} for items in page_items]
    path.write_text("\n".join(json.dumps(x) for x in lines))
    return spark.read.schema(schemas.CATALOG_B_PAGE).json(str(path))


def item(**changes):
    return {k: v for k, v in {**ITEM, **changes}.items() if v != "drop"}


def test_pages(spark, tmp_path):
    df = pages(
        spark,
        tmp_path,
        None,
        [],
        [
            item(),
            item(productName="NC Series Windows"),
            item(priceType="Reservation"),
            item(armRegionName="northeurope"),
            item(serviceName="Storage"),
            item(skuName="D2s_v3"),
            item(skuName="drop"),
        ],
        [
            item(skuName="NC6s Low Priority", unitPrice=None, currencyCode="drop"),
            item(skuName="nc8AS_T4_v3 Spot", productName=None, armRegionName="westus2"),
        ],
    )
    got = flatten_pages(df, ["eastus", "westus2", "eastus2"])
    rows = {
        (r.instance_type, r.region, r.price_per_hour, r.price_type, r.currency, r.tier, r.hw_type)
        for r in got.collect()
    }
    assert rows == {
        ("NC4as_T4_v3", "eastus", 0.526, "on_demand", "USD", "Inference", "T4"),
        ("NC6s Low Priority", "eastus", None, "spot", "USD", "Edge", "unknown"),
        ("nc8AS_T4_v3 Spot", "westus2", 0.526, "spot", "USD", "Inference", "T4"),
    }
    back = reparse(got.where("price_type = 'on_demand'"), schemas.CATALOG_B_ITEM)
    assert back.select("payload.*").first().asDict() == ITEM


@pytest.mark.parametrize("strip,tier", [("^Standard_", "Inference"), (None, "Fine-tuning")])
def test_sku_prefix_trap(spark, tmp_path, strip, tier):
    df = pages(spark, tmp_path, [item(skuName="Standard_NC4as_T4_v3")])
    row = flatten_pages(df, ["eastus"], strip).first()
    assert (row.instance_type, row.tier, row.hw_type) == ("Standard_NC4as_T4_v3", tier, "T4")


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("A", "8")], "provider string, vcpu string")
    b = spark.createDataFrame([("B", "x")], "provider string, product_name string")
    rows = union_providers(a, b).orderBy("provider").collect()
    assert [r.asDict() for r in rows] == [
        {"provider": "A", "vcpu": "8", "product_name": None},
        {"provider": "B", "vcpu": None, "product_name": "x"},
    ]


def test_landing_of_an_empty_batch_writes_no_line(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.5)], "provider string, price_per_hour double")
    assert land(df.where("provider = 'B'"), str(tmp_path / "none")) is False
    assert spark.read.text(str(tmp_path / "none")).count() == 0
    assert land(df, str(tmp_path / "a")) and land(df, str(tmp_path / "a"))
    back = spark.read.schema(schemas.LANDING).json(str(tmp_path / "a"))
    assert back.count() == 2 and back.first().price_per_hour == 1.5


def test_schema_discovery(spark, tmp_path):
    a = spark.createDataFrame([("A", 1.5)], "provider string, price_per_hour double")
    b = spark.createDataFrame([("B", 3)], "provider string, vcpu long")
    land(a, str(tmp_path / "a"))
    land(b, str(tmp_path / "b"))
    found = {f.name: f.dataType.simpleString() for f in discover_schema(spark, str(tmp_path))}
    assert found == {"price_per_hour": "double", "provider": "string", "vcpu": "bigint"}


def test_catalogue_b_keeps_the_whole_item(spark, tmp_path):
    item = {
        "skuName": "NC4as_T4_v3", "unitPrice": 1.5, "serviceName": "Virtual Machines",
        "armRegionName": "eastus", "priceType": "Consumption", "meterId": "m1",
        "unitOfMeasure": "1 Hour", "more": {"deep": [1, 2]},
    }
    (tmp_path / "1.json").write_text(json.dumps({"Items": [item]}))
    pages = spark.read.schema(schemas.CATALOG_B_RAW_PAGE).json(str(tmp_path))
    row = flatten_pages(pages, ["eastus"]).first()
    assert row.price_per_hour == 1.5
    assert json.loads(row.raw_payload) == item


def test_landing_keeps_microseconds(spark, tmp_path):
    from quotegrid.sources.landing import JSON_OPTIONS

    df = spark.sql(
        "select timestamp_ntz'2024-01-01 00:00:07.179575' as n, "
        "timestamp'2024-01-01 00:00:07.179575' as t"
    )
    land(df, str(tmp_path / "t"))
    back = spark.read.schema(df.schema).options(**JSON_OPTIONS).json(str(tmp_path / "t"))
    assert back.collect() == df.collect()
