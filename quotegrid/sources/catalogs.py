"""Nested and paged price catalogues flattened to landing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid import reference_data as ref
from quotegrid.functions.rules import any_prefix, any_substring, classify
from quotegrid.functions.scalars import all_rates, attribute, last_price
from quotegrid.functions.variants import column_kind, inferred, typed
from quotegrid.schemas import CATALOG_B_ITEM


def match_all(df: DataFrame, equals: Mapping[str, str]) -> DataFrame:
    """Rows where every given column, field or map entry has its value; null never does."""
    tests = [F.col(c) == v for c, v in equals.items()]
    return df.where(reduce(and_, tests)) if tests else df


def flatten_terms(products: DataFrame, terms: DataFrame, region: str) -> DataFrame:
    """Products x on-demand terms of catalogue A -> landing rows.

    ``products`` has one (sku, attributes) row per SKU and ``terms`` one (sku, offers) row.
    Both sides are filtered before the join and may both be large, so the join carries no
    hint: it is keyed on the unique SKU and adaptive execution picks its form.
    """
    instance = attribute(F.col("attributes"), "instanceType")
    wanted = products.where(any_prefix(instance, ref.A_FAMILIES))
    wanted = match_all(wanted, {f"attributes.{k}": v for k, v in ref.A_ATTRIBUTES.items()})
    priced = terms.select("sku", last_price(F.col("offers")).alias("price_per_hour")).where(
        F.col("price_per_hour").isNotNull() & (F.col("price_per_hour") != 0)
    )
    attributes = F.col("attributes")
    return wanted.join(priced, "sku").select(
        F.lit(ref.PROVIDER_A).alias("provider"),
        instance.alias("instance_type"),
        classify(instance, ref.A_HARDWARE, ref.UNKNOWN_HW).alias("hw_type"),
        attribute(attributes, "gpuMemory", "unknown").alias("unit_text"),
        attribute(attributes, "vcpu").alias("vcpu"),
        attribute(attributes, "memory").alias("memory_gb"),
        F.lit(region).alias("region"),
        "price_per_hour",
        F.lit(ref.DEFAULT_PRICE_TYPE).alias("price_type"),
        classify(instance, ref.A_TIERS, ref.UNKNOWN_TIER).alias("tier"),
        F.to_json(attributes).alias("raw_payload"),
    )


def ambiguous_terms(terms: DataFrame) -> DataFrame:
    """SKUs whose terms hold more than one rate, so that the last one was picked."""
    return terms.select("sku", F.size(all_rates(F.col("offers"))).alias("rates")).where(
        "rates > 1"
    )


def flatten_pages(
    pages: DataFrame, regions: Sequence[str], strip: str | None = ref.SKU_PREFIX
) -> DataFrame:
    """Result pages of catalogue B -> landing rows.

    Items are the texts of CATALOG_B_RAW_PAGE, kept whole as the payload, or structs.
    ``strip`` is removed from the SKU before the rules look at it, since the rule word "nd"
    also occurs in "Standard_"; pass None to classify the SKU text as it is.
    """
    raw = pages.select(F.explode("Items").alias("raw"))
    if isinstance(pages.schema["Items"].dataType.elementType, T.StringType):
        items = raw.select(F.from_json("raw", CATALOG_B_ITEM).alias("item"), "raw")
    else:
        items = raw.select(F.col("raw").alias("item"), F.to_json("raw").alias("raw"))
    sku, product = F.col("item.skuName"), F.col("item.productName")
    text = F.regexp_replace(sku, strip, "") if strip else sku
    rows = match_all(
        items, {"item.serviceName": ref.B_SERVICE, "item.priceType": ref.B_PRICE_TYPE}
    )
    rows = rows.where(
        F.col("item.armRegionName").isin(list(regions))
        & ~F.coalesce(product.contains(ref.B_EXCLUDED_PRODUCT), F.lit(False))
        & any_substring(sku, ref.B_KEYWORDS)
    )
    return rows.select(
        F.lit(ref.PROVIDER_B).alias("provider"),
        sku.alias("instance_type"),
        product.alias("product_name"),
        classify(text, ref.B_HARDWARE, ref.UNKNOWN_HW, ignore_case=True).alias("hw_type"),
        F.col("item.armRegionName").alias("region"),
        F.col("item.unitPrice").alias("price_per_hour"),
        classify(sku, ref.B_PRICE_TYPES, ref.DEFAULT_PRICE_TYPE).alias("price_type"),
        F.coalesce("item.currencyCode", F.lit(ref.DEFAULT_CURRENCY)).alias("currency"),
        classify(text, ref.B_TIERS, ref.UNKNOWN_TIER, ignore_case=True).alias("tier"),
        F.col("raw").alias("raw_payload"),
    )


def union_providers(*frames: DataFrame) -> DataFrame:
    """Rows of all providers; a column that one of them lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def reparse(bronze: DataFrame, schema: T.DataType | str) -> DataFrame:
    """Bronze rows plus ``payload``, their kept raw JSON read with ``schema``."""
    return bronze.withColumn("payload", F.from_json("raw_payload", schema))


def parsed_payload(bronze: DataFrame) -> DataFrame:
    """Bronze rows plus ``payload``, their raw JSON as a variant; null where it is none.

    No schema has to be known: see ``payload_fields`` for what there is.
    """
    return bronze.withColumn("payload", F.try_parse_json("raw_payload"))


def payload_fields(bronze: DataFrame) -> dict[str, T.DataType]:
    """Paths of all payload fields with the type that holds their values.

    One mergeable aggregate; only its text, as long as there are fields, reaches the driver.
    """

    def fields(kind: T.StructType, prefix: str) -> dict[str, T.DataType]:
        found = {}
        for field in kind.fields:
            path = f"{prefix}['{field.name}']"
            if isinstance(field.dataType, T.StructType):
                found |= fields(field.dataType, path)
            else:
                found[path] = column_kind(field.dataType) or T.StringType()
        return found

    payload = parsed_payload(bronze).agg(F.schema_of_variant_agg("payload")).first()[0]
    kind = inferred(payload)
    return fields(kind, "$") if isinstance(kind, T.StructType) else {}


def with_payload_fields(bronze: DataFrame, fields: Mapping[str, tuple[str, T.DataType]]) -> DataFrame:
    """Bronze rows plus a typed column per payload path; null where the value does not fit."""
    value = lambda path: F.try_variant_get(F.try_parse_json("raw_payload"), path, "variant")
    return bronze.withColumns(
        {name: typed(value(path), kind) for name, (path, kind) in fields.items()}
    )
