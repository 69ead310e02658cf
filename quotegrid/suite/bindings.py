"""The driver tables seen as price data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binding; the SQL side states the same ones.
BRAND_UNITS = {"Brand#1": 8, "Brand#2": 4, "Brand#3": 2}
PROVIDERS = ["P1", "P2"]
TIER_OF_TYPE = {
    "PROMO": "Training",
    "LARGE": "Training",
    "MEDIUM": "Fine-tuning",
    "SMALL": "Inference",
    "ECONOMY": "Edge",
}
TYPE_WEIGHTS = {"PROMO": 1.0, "LARGE": 0.5, "MEDIUM": 0.4, "unknown": 0.25}

# Instance and SKU names by brand number 1 to 25.
INSTANCES = [
    "p4d.24xlarge", "p4de.24xlarge", "p5.48xlarge", "p3.2xlarge", "p3.8xlarge",
    "p3.16xlarge", "p3dn.24xlarge", "g5.xlarge", "g5.12xlarge", "g5.48xlarge",
    "g4dn.xlarge", "g4dn.12xlarge", "g4ad.xlarge", "g6.xlarge", "g6.12xlarge",
    "g6e.12xlarge", "g6f.48xlarge", "inf1.xlarge", "inf1.24xlarge", "inf2.xlarge",
    "inf2.48xlarge", "m5.large", "c5.large", "r5.large", "t3.micro",
]
SKUS = [
    "ND96asr_v4", "ND96amsr_A100_v4", "ND96asrA100v4_NU", "ND40rs_v2", "NC24ads_A100_v4",
    "NC4as_T4_v3", "NC8as_T4_v3", "NC16as_T4_v3", "NC64as_T4_v3", "NV6ads_A10_v5",
    "NV18ads_A10_v5", "NV36ads_A10_v5", "NV72ads_A10_v5", "NC6s_v3", "NC12s_v3",
    "NC24s_v3", "NC24rs_v3", "Standard_NC4as_T4_v3", "Standard_NC12s_v3",
    "NC6s Low Priority", "D2s_v3", "E4s_v5", "F8s_v2", "ND96isr", "NC6 Promo",
]
REGION_OF_TYPE = {"PROMO": "eastus", "LARGE": "westus2", "MEDIUM": "eastus2", "SMALL": "eastus"}
OTHER_REGION = "northeurope"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col: str, mapping: dict[str, str], default: str) -> Column:
    chain = F
    for value, label in mapping.items():
        chain = chain.when(F.col(col) == value, label)
    return chain.otherwise(default)


def brand_name(names: list[str]) -> Column:
    """The name at the part's brand number."""
    number = F.regexp_replace("p_brand", "^Brand#", "").cast("int")
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def quotes(spark: SparkSession, sf_dir: str, fine: bool = False) -> DataFrame:
    """Line items as price observations.

    Instances and regions are brands and nations, a few thousand keys whatever the scale
    factor; ``fine`` names parts and suppliers, so that keys grow with the data.
    """
    instance, region = F.col("p_brand"), F.col("n_name")
    if fine:
        instance = F.concat_ws("-", instance, "p_partkey")
        region = F.concat_ws(":", region, "s_suppkey")
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        F.when(F.col("l_linestatus") == "F", "P1").otherwise("P2").alias("provider"),
        instance.alias("instance_type"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("hw_type"),
        region.alias("region"),
        F.col("l_extendedprice").alias("price_per_hour"),
        F.when(F.col("l_returnflag") == "R", "spot").otherwise("on_demand").alias("price_type"),
        F.lit("USD").alias("currency"),
        _case("p_type", TIER_OF_TYPE, "Unknown").alias("tier"),
        F.col("l_shipdate").alias("ingested_at"),
        F.col("s_name").alias("source_file"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue A products; some lack an attribute or have another value."""
    attributes = {
        "instanceType": brand_name(INSTANCES),
        "operatingSystem": F.when(F.col("p_size") <= 40, "Linux").otherwise("Windows"),
        "tenancy": F.when(F.col("p_type") == "ECONOMY", "Dedicated").otherwise("Shared"),
        "capacitystatus": F.when(F.col("p_size") != 7, "Used"),
        "gpuMemory": F.when(F.col("p_type") != "PROMO", F.concat_ws(" ", "p_size", F.lit("GB"))),
        "vcpu": F.col("p_size").cast("string"),
        "memory": F.col("p_name"),
    }
    entries = [x for name, value in attributes.items() for x in (F.lit(name), value)]
    stated = F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("sku"), stated.alias("attributes")
    )


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lowest and highest line price per part as nested offers of catalogue A, 1 to 3 rates.

    The last rate is the one that counts: it may lack a dollar price, be zero or no number.
    """
    by_part = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))
    )
    low, high = F.col("low").cast("string"), F.col("high").cast("string")
    last = (
        F.when(F.col("high") > 104000, F.create_map(F.lit("EUR"), high))
        .when(F.col("low") < 1200, F.create_map(F.lit("USD"), F.lit("n/a")))
        .when(F.col("low") < 1500, F.create_map(F.lit("USD"), F.lit("0")))
        .otherwise(F.create_map(F.lit("EUR"), high, F.lit("USD"), high))
    )

    def rate(prices: Column) -> Column:
        return F.struct(prices.alias("pricePerUnit"))

    def offer(*rates: Column) -> Column:
        named = [x for i, r in enumerate(rates, 1) for x in (F.lit(f"r{i}"), r)]
        return F.struct(F.create_map(*named).alias("priceDimensions"))

    lowest = rate(F.create_map(F.lit("USD"), low))
    base, kind = (F.lit("base"), offer(lowest)), F.col("l_partkey") % 3
    offers = (
        F.when(kind == 0, F.create_map(*base, F.lit("list"), offer(lowest)))
        .when(kind == 1, F.create_map(*base))
        .otherwise(F.create_map(*base, F.lit("list"), offer(lowest, rate(last))))
    )
    return by_part.select(F.col("l_partkey").cast("string").alias("sku"), offers.alias("offers"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part as a page of catalogue B with a plain, a spot and a Windows item."""
    sku = brand_name(SKUS)

    def item(name: Column, product: Column, price: Column) -> Column:
        return F.struct(
            name.alias("skuName"),
            product.alias("productName"),
            price.alias("unitPrice"),
            F.when(F.col("p_size") > 25, "USD").alias("currencyCode"),
            F.when(F.col("p_size") == 50, "Storage").otherwise("Virtual Machines").alias(
                "serviceName"
            ),
            _case("p_type", REGION_OF_TYPE, OTHER_REGION).alias("armRegionName"),
            F.when(F.col("p_size") == 49, "Reservation").otherwise("Consumption").alias(
                "priceType"
            ),
            # A field that the declared schema lacks: the payload must keep it.
            F.concat(F.lit("m"), "p_partkey").alias("meterId"),
        )

    retail, name = F.col("p_retailprice"), F.col("p_name")
    no_name = F.when(F.col("p_size") != 3, name)
    items = F.array(
        item(sku, no_name, retail),
        item(F.concat(sku, F.lit(" Spot")), name, retail / 4),
        item(sku, F.concat(name, F.lit(" Windows")), retail * 2),
    )
    return table(spark, sf_dir, "part").select(
        items.alias("Items"), F.lit(None).cast("string").alias("NextPageLink")
    )
