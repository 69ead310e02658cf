"""One query per operator, over the driver tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid import reference_data as ref
from quotegrid.functions.rules import Rule, any_prefix, any_substring, classify
from quotegrid.functions.scalars import attribute, deviation, mean
from quotegrid.operators import derived, history, index, latest, profile, quality, sketches, units
from quotegrid.operators.quantiles import QUARTILES, exact_quantiles
from quotegrid.plans import reports, series
from quotegrid.plans.gold import assemble_gold, build_gold, index_rows, stamp
from quotegrid.plans.latest import advance_parts, latest_rows
from quotegrid.plans.run import Paths, run
from quotegrid.plans.silver import build_silver, current_quotes
from quotegrid.schemas import BRONZE
from quotegrid.session import work_dir
from quotegrid.sources import catalogs, tables
from quotegrid.sources.landing import land
from quotegrid.streaming.bronze import (
    drain,
    load_counts,
    next_load,
    note_load,
    split_corrupt,
    stream_landing,
)
from quotegrid.streaming.growth import bronze_schema, grow, promoted_columns
from quotegrid.suite import bindings as b

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TIME = "2002-01-01 06:00:00"
CUTOFF = "1998-06-30 00:00:00"
PART_NUMBER = "-[0-9]+$"
URL_RULES = [
    Rule("blog", any_of=("://blog.",)),
    Rule("campaign", any_of=("utm_source=", "ref=")),
    Rule("secure mobile", all_of=("https:", "//m.")),
]


def register(query: Query) -> Query:
    """Add a query under its function name; session dates are read in UTC."""

    @wraps(query)
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        try:
            rows = query(spark, sf_dir)
            rows.schema  # noqa: B018  analysed, and dated, in UTC
            return rows
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    QUERIES[query.__name__] = in_utc
    return query


def silver(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Silver of parts and suppliers, which grows with the data."""
    quotes = b.quotes(spark, sf_dir, fine=True)
    return build_silver(quotes, b.BRAND_UNITS, PART_NUMBER, as_of=RUN_TIME, **options)


def plain_times(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as UTC wall-clock times, which every engine shows alike."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def written_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a written table, which the Gold branches read."""
    return tables.settle(silver(spark, sf_dir), "silver")


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.index_universe(written_silver(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return build_gold(written_silver(spark, sf_dir), b.PROVIDERS, as_of=RUN_TIME, **options)


def month_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quotes' index at every month end."""
    newest = b.table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).scalar()
    standing = series.standing_quotes(b.quotes(spark, sf_dir))
    clean = units.normalise_units(quality.quality_gate(standing), b.BRAND_UNITS)
    on_demand = index.index_universe(clean).drop("product_name", "currency", "source_file")
    return series.month_end_gold(tables.settle(on_demand, "standing"), newest, b.PROVIDERS)


SERIES_COLUMNS = ["index_date", "tier", "index_median", "index_mean", "sample_size", "spread_pct"]


@register
def q01_tier_index(spark, sf_dir):
    return index.tier_index(universe(spark, sf_dir))


@register
def q02_provider_summary(spark, sf_dir):
    return index.provider_summary(universe(spark, sf_dir))


@register
def q03_provider_spread(spark, sf_dir):
    return index.provider_spread(index.provider_summary(universe(spark, sf_dir)), b.PROVIDERS)


@register
def q04_best_value(spark, sf_dir):
    return index.best_value(universe(spark, sf_dir))


@register
def q05_gold_assembled(spark, sf_dir):
    rows = universe(spark, sf_dir)
    spread = index.provider_spread(index.provider_summary(rows), b.PROVIDERS)
    return assemble_gold(index.tier_index(rows), spread, index.best_value(rows))


@register
def q06_gold_single_pass(spark, sf_dir):
    """The kept Gold form: one histogram of prices serves all quantiles."""
    return plain_times(gold(spark, sf_dir), "index_timestamp")


@register
def q07_latest_per_key(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    return latest.latest_per_key(events, ["user_id", "event_type"], ts="ts")


@register
def q08_quality_gate_rejects(spark, sf_dir):
    """Prices less 5000, so that some are not positive, counted by reason and tier."""
    lowered = b.quotes(spark, sf_dir).withColumn(
        "price_per_hour", F.col("price_per_hour") - 5000
    )
    return profile.frequency(quality.quality_rejects(lowered), "reject_reason", "tier")


@register
def q09_unit_normalise(spark, sf_dir):
    return units.normalise_units(b.quotes(spark, sf_dir), b.BRAND_UNITS).select(
        "instance_type", "price_per_hour", "unit_count", "unit_count_known", "unit_price"
    )


@register
def q10_prefix_rules(spark, sf_dir):
    instance = F.col("instance")
    return (
        b.table(spark, sf_dir, "part")
        .select("p_partkey", b.brand_name(b.INSTANCES).alias("instance"))
        .withColumns(
            {
                "listed": any_prefix(instance, ref.A_FAMILIES),
                "tier": classify(instance, ref.A_TIERS, ref.UNKNOWN_TIER),
                "hw_type": classify(instance, ref.A_HARDWARE, ref.UNKNOWN_HW),
            }
        )
    )


@register
def q11_substring_rules(spark, sf_dir):
    url = F.col("url")
    return b.table(spark, sf_dir, "pages").select(
        "page_id",
        any_substring(url, ["EXAMPLE.ORG", "spam-farm"]).alias("listed"),
        classify(url, URL_RULES, "other", ignore_case=True).alias("label"),
    )


@register
def q12_prefix_strip(spark, sf_dir):
    return b.table(spark, sf_dir, "part").select(
        "p_partkey", F.regexp_replace("p_brand", "^Brand#", "").alias("brand")
    )


@register
def q13_predicate_conjunction(spark, sf_dir):
    rows = catalogs.match_all(
        b.table(spark, sf_dir, "lineitem"), {"l_returnflag": "R", "l_linestatus": "F"}
    ).where(F.col("l_discount").isNotNull() & (F.col("l_discount") != 0))
    urgent = catalogs.match_all(
        b.table(spark, sf_dir, "orders"), {"o_orderstatus": "O", "o_orderpriority": "1-URGENT"}
    )
    return rows.join(urgent, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount"
    )


@register
def q14_json_parse_defaults(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").withColumnRenamed("props", "raw_payload")
    parsed = catalogs.reparse(events, "map<string,string>")
    return parsed.select(
        "event_id",
        attribute(F.col("payload"), "k").try_cast("double").alias("k"),
        attribute(F.col("payload"), "currency", "USD").alias("currency"),
    )


CATALOG_COLUMNS = [
    "provider", "instance_type", "hw_type", "region", "price_per_hour", "price_type", "tier",
]


@register
def q15_explode_nested(spark, sf_dir):
    rows = catalogs.flatten_terms(
        b.products(spark, sf_dir), b.terms(spark, sf_dir), "us-east-1"
    )
    return rows.select(*CATALOG_COLUMNS, "unit_text", "vcpu", "memory_gb")


@register
def q16_union_missing_columns(spark, sf_dir):
    customers = b.table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("party"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = b.table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("party"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").cast("bigint").alias("nation"),
    )
    return catalogs.union_providers(customers, suppliers)


@register
def q17_group_counts(spark, sf_dir):
    return profile.frequency(b.table(spark, sf_dir, "events"), "event_type", "user_id").orderBy(
        "event_type", "user_id"
    )


@register
def q18_layer_counts(spark, sf_dir):
    return profile.layer_counts(b.quotes(spark, sf_dir))


@register
def q19_tier_summary(spark, sf_dir):
    return profile.tier_summary(silver(spark, sf_dir, weights=b.TYPE_WEIGHTS))


@register
def q20_perf_adjusted(spark, sf_dir):
    return silver(spark, sf_dir, weights=b.TYPE_WEIGHTS).transform(
        plain_times, "transformed_at"
    )


@register
def q21_dispersion_iqr(spark, sf_dir):
    rows = derived.dispersion(index.tier_index(universe(spark, sf_dir)))
    return rows.select("tier", "index_median", "index_stddev", "stddev_pct", "iqr")


@register
def q22_tier_premium(spark, sf_dir):
    rows = stamp(index.tier_index(universe(spark, sf_dir)), RUN_TIME)
    return derived.tier_premium(rows, "Inference").select("tier", "index_median", "premium")


@register
def q23_excluded_tier_index(spark, sf_dir):
    edge_only = index.index_universe(
        silver(spark, sf_dir), exclude_tiers=("Training", "Fine-tuning", "Inference")
    )
    return index_rows(edge_only, b.PROVIDERS)


@register
def q24_snapshot_series(spark, sf_dir):
    return plain_times(month_ends(spark, sf_dir), "index_timestamp")


@register
def q25_as_of(spark, sf_dir):
    return history.as_of(month_ends(spark, sf_dir), CUTOFF).select(*SERIES_COLUMNS)


@register
def q26_latest_snapshot(spark, sf_dir):
    return history.latest_snapshot(month_ends(spark, sf_dir)).select(*SERIES_COLUMNS)


@register
def q27_version_as_of(spark, sf_dir):
    return history.version_as_of(month_ends(spark, sf_dir), 5).select(*SERIES_COLUMNS)


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def drained_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed in two parts, drained after each part and once more without news."""
    events = b.table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    root = work_dir(spark, "events")
    landing, out, checkpoint = (f"{root}/{x}" for x in ("landing", "bronze", "checkpoint"))

    def load() -> None:
        number = next_load(spark, out)
        drain(stream_landing(spark, landing, events.schema, load=number), out, checkpoint)

    buys = F.col("event_type") == "purchase"
    land(events.where(buys), f"{landing}/purchases")
    load()
    land(events.where(~buys), f"{landing}/others")
    load()
    load()
    good, _ = split_corrupt(spark.read.parquet(out))
    return good


@register
def q28_stream_bronze(spark, sf_dir):
    """All events, once each, with the load they came in."""
    loaded = F.col("source_file").isNotNull() & F.col("ingested_at").isNotNull()
    return drained_events(spark, sf_dir).select(
        *EVENT_COLUMNS, "load", "_rescued_data", loaded.alias("stamped")
    )


@register
def q29_snapshot_rewrite(spark, sf_dir):
    root = work_dir(spark, "snapshots")
    tables.overwrite(month_ends(spark, sf_dir), f"{root}/run")
    snapshot = tables.read(spark, f"{root}/run")
    kept = []
    for mode in ("append", "replace_date"):
        for _ in range(2):
            tables.write_snapshot(snapshot, f"{root}/{mode}", mode)
        rows = tables.read(spark, f"{root}/{mode}", merge=True)
        kept.append(profile.frequency(rows, "index_date").withColumn("mode", F.lit(mode)))
    return catalogs.union_providers(*kept)


@register
def q30_stream_quarantine(spark, sf_dir):
    """Error events land as broken lines and signups with a text for their value."""
    root = work_dir(spark, "quarantine")
    fine = F.to_json(F.struct("event_id", "event_type", "value"))
    mistyped = F.to_json(F.struct("event_id", "event_type", F.lit("high").alias("value")))
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"event_id": '), "event_id"))
        .when(F.col("event_type") == "signup", mistyped)
        .otherwise(fine)
    )
    b.table(spark, sf_dir, "events").select(line.alias("value")).write.text(f"{root}/landing")
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    drain(stream_landing(spark, f"{root}/landing", schema), f"{root}/out", f"{root}/checkpoint")
    good, bad = split_corrupt(spark.read.parquet(f"{root}/out"))
    return catalogs.union_providers(
        good.select(F.lit("good").alias("state"), "event_id", "event_type", "value"),
        bad.select(F.lit("quarantined").alias("state"), F.col("_corrupt_record").alias("line")),
    )


@register
def q31_approx_index(spark, sf_dir):
    """Per tier, whether each quartile of the sketch has a rank within the stated bound."""
    rows, accuracy = universe(spark, sf_dir), 1_000
    found = index_rows(rows, b.PROVIDERS, approx=True, accuracy=accuracy)
    quartiles = found.select("tier", "sample_size", *QUARTILES)
    prices = rows.select("tier", "unit_price").join(quartiles, "tier")
    counts, checks = [], []
    for name, p in QUARTILES.items():
        price, limit = F.col("unit_price"), F.col(name)
        counts += [F.count_if(price < limit).alias(f"{name}_below")]
        counts += [F.count_if(price <= limit).alias(f"{name}_upto")]
        rank, slack = p * F.col("sample_size"), F.col("sample_size") / accuracy + 1
        above = F.col(f"{name}_below") <= rank + slack
        checks += [(above & (F.col(f"{name}_upto") >= rank - slack)).alias(f"{name}_within")]
    return prices.groupBy("tier", "sample_size").agg(*counts).select("tier", "sample_size", *checks)


@register
def q32_reports(spark, sf_dir):
    rows = gold(spark, sf_dir)
    return reports.index_report(rows, b.PROVIDERS)


@register
def q33_best_value_report(spark, sf_dir):
    return reports.best_value_report(gold(spark, sf_dir))


@register
def q34_paged_catalog(spark, sf_dir):
    rows = catalogs.flatten_pages(b.pages(spark, sf_dir), ref.B_REGIONS)
    return rows.select(*CATALOG_COLUMNS, "product_name", "currency")


@register
def q35_group_quantiles(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    return exact_quantiles(
        lines,
        ["l_returnflag", "l_linestatus"],
        "l_extendedprice",
        {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99},
    )


@register
def q36_source_inventory(spark, sf_dir):
    return profile.source_inventory(b.quotes(spark, sf_dir))


@register
def q37_region_pages(spark, sf_dir):
    return profile.region_pages(b.quotes(spark, sf_dir))


@register
def q38_refresh_latest(spark, sf_dir):
    rows = b.quotes(spark, sf_dir)
    arrived = F.col("ingested_at") > F.lit(CUTOFF).cast("timestamp_ntz")
    before = latest.latest_per_key(rows.where(~arrived))
    return latest.refresh_latest(before, rows.where(arrived))


@register
def q39_filter_first(spark, sf_dir):
    return current_quotes(b.quotes(spark, sf_dir), filter_first=True)


@register
def q40_raw_payload(spark, sf_dir):
    """What the kept payloads of both catalogues still tell."""
    rows = catalogs.union_providers(
        catalogs.flatten_terms(b.products(spark, sf_dir), b.terms(spark, sf_dir), "us-east-1"),
        catalogs.flatten_pages(b.pages(spark, sf_dir), ref.B_REGIONS),
    )
    payload = F.col("payload")
    return catalogs.reparse(rows, "map<string,string>").select(
        "instance_type",
        F.coalesce(attribute(payload, "instanceType"), attribute(payload, "skuName")).alias(
            "raw_instance"
        ),
        attribute(payload, "gpuMemory").alias("raw_memory"),
        attribute(payload, "meterId").alias("raw_meter"),
        F.size(payload).alias("entries"),
    )


@register
def q41_ambiguous_terms(spark, sf_dir):
    return catalogs.ambiguous_terms(b.terms(spark, sf_dir))


@register
def q43_bronze_breakdown(spark, sf_dir):
    return profile.frequency(b.quotes(spark, sf_dir), "provider", "tier").orderBy(
        "provider", "tier"
    )


@register
def q44_sub_index_spread(spark, sf_dir):
    """Spread of every tier's spot prices, the excluded tier among them."""
    spot = index.index_universe(written_silver(spark, sf_dir), "spot", exclude_tiers=())
    return index.provider_spread(index.provider_summary(spot), b.PROVIDERS, base="P2")


def daily_paths(spark: SparkSession, sf_dir: str) -> Paths:
    """Folders of a new run with both catalogues as JSON files."""
    root = work_dir(spark, "daily")
    paths = Paths(
        **{
            name: f"{root}/{name}"
            for name in (
                "products", "terms", "pages", "landing",
                "checkpoint", "bronze", "silver", "gold", "latest",
            )
        }
    )
    for name, frame in (("products", b.products), ("terms", b.terms), ("pages", b.pages)):
        frame(spark, sf_dir).write.json(getattr(paths, name))
    return paths


@register
def q42_daily_run(spark, sf_dir):
    """Both catalogues through the whole run to Gold, twice on one day."""
    paths = daily_paths(spark, sf_dir)
    for _ in range(2):
        run(spark, paths, as_of=RUN_TIME, snapshot_mode="replace_date")
    return plain_times(tables.read(spark, paths.gold, merge=True), "index_timestamp")


@register
def q45_units_table(spark, sf_dir):
    """Units per instance from a dimension table: the largest size of each brand."""
    sizes = b.table(spark, sf_dir, "part").groupBy("p_brand").agg(F.max("p_size").alias("units"))
    return units.normalise_units(b.quotes(spark, sf_dir), sizes).select(
        "instance_type", "price_per_hour", "unit_count", "unit_count_known", "unit_price"
    )


@register
def q46_price_range(spark, sf_dir):
    """Infinite and huge prices are rejects with a reason, and the mean goes on without them."""
    price = F.col("price_per_hour")
    odd = (
        F.when(price > 100_000, float("inf")).when(price < 2_000, 1e17).otherwise(price)
    )
    rows = b.quotes(spark, sf_dir).withColumn("price_per_hour", odd)
    bad = profile.frequency(quality.quality_rejects(rows), "reject_reason")
    fine = quality.quality_gate(rows).agg(
        F.lit("none").alias("reject_reason"),
        F.count("*").alias("n"),
        mean("price_per_hour").alias("mean_price"),
    )
    return catalogs.union_providers(bad, fine)


@register
def q47_exact_ranks(spark, sf_dir):
    """Quantiles of a large whole number, at shares that binary fractions miss."""
    lines = b.table(spark, sf_dir, "lineitem").withColumn(
        "big", F.col("l_orderkey").cast("bigint") * 100_000_000_000
    )
    shares = {"p07": 0.07, "p14": 0.14, "p28": 0.28, "p55": 0.55}
    return exact_quantiles(lines, ["l_returnflag"], "big", shares)


@register
def q48_rescued_fields(spark, sf_dir):
    """Landed fields that the declared schema lacks are kept beside the row."""
    root = work_dir(spark, "rescued")
    events = b.table(spark, sf_dir, "events")
    land(events.select("event_id", "event_type", "user_id"), f"{root}/landing")
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())]
    )
    drain(stream_landing(spark, f"{root}/landing", schema), f"{root}/out", f"{root}/checkpoint")
    extra = F.from_json("_rescued_data", "map<string,string>")
    return spark.read.parquet(f"{root}/out").select(
        "event_id", "event_type", extra["user_id"].alias("rescued_user")
    )


@register
def q49_first_row(spark, sf_dir):
    return b.table(spark, sf_dir, "events").orderBy(F.desc("ts"), "event_id").limit(1)


@register
def q50_run_checks(spark, sf_dir):
    """Rows per layer, as a first run reports them."""
    return run(spark, daily_paths(spark, sf_dir), as_of=RUN_TIME)["layers"]




def growing_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events in three loads, two fields from the second on: (Bronze, rows per load)."""
    events, root = b.table(spark, sf_dir, "events"), work_dir(spark, "growing")
    landing, out, versions, loads = (f"{root}/{x}" for x in ("raw", "bronze", "versions", "loads"))
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())]
    )
    # Every fiftieth user of the last load is no number; such a value stays rescued.
    user = F.col("user_id").cast("string")
    odd = F.when(F.col("user_id") % 50 == 0, F.concat(F.lit("u"), user)).otherwise(user)
    parts = [("event_id", "event_type"), ("event_id", "event_type", "user_id", "value")]
    parts += [("event_id", "event_type", odd.alias("user_id"), "value")]
    for number, columns in enumerate(parts):
        part = events.where(F.col("event_id") % 3 == number)
        broken = part.where(F.col("event_id") % 30 == number)
        land(part.select(*columns), f"{landing}/{number}")
        line = F.concat(F.lit('{"event_id": '), "event_id")
        broken.select(line.alias("value")).write.text(f"{landing}/{number}/broken")
        load, promoted = next_load(spark, out), promoted_columns(spark, versions)
        stream = stream_landing(spark, landing, schema, load=load, promoted=promoted)
        note_load(spark, loads, load, drain(stream, out, f"{root}/checkpoint", promoted))
        declared = T.StructType([*schema.fields, *BRONZE.fields[-5:]])
        bronze = spark.read.schema(bronze_schema(spark, versions, declared)).parquet(out)
        grow(spark, bronze, versions)
    return bronze, load_counts(spark, loads, out)


@register
def q51_schema_growth(spark, sf_dir):
    """Fields that turn up in load 2 are typed columns from load 3 on, older rows null."""
    good, _ = split_corrupt(growing_events(spark, sf_dir)[0])
    rescued = F.from_json("_rescued_data", "map<string,string>")
    return good.select(
        "event_id", "event_type", "load", "user_id", "value", rescued["user_id"].alias("rescued_user")
    )


@register
def q52_load_counts(spark, sf_dir):
    """Rows per load as the loads themselves counted them."""
    return growing_events(spark, sf_dir)[1]


@register
def q53_merged_loads(spark, sf_dir):
    """The index over the kept summaries of all loads, and whether its quartiles' ranks hold."""
    quotes = units.normalise_units(
        quality.quality_gate(b.quotes(spark, sf_dir, fine=True)), b.BRAND_UNITS, PART_NUMBER
    )
    loads = index.index_universe(quotes).withColumn("load", F.year("ingested_at"))
    rows = tables.settle(loads, "loads")
    kept = tables.settle(sketches.price_summaries(rows), "summaries")
    found = sketches.index_of_summaries(kept, b.PROVIDERS)
    exact = [c for c in index.INDEX_COLUMNS if c not in QUARTILES]
    quartiles = found.select("tier", *QUARTILES, *exact, *index.BEST_VALUE)
    prices = rows.select("tier", "unit_price").join(quartiles, "tier")
    size, counts, checks = F.col("sample_size"), [], []
    for name, p in QUARTILES.items():
        price, limit = F.col("unit_price"), F.col(name)
        counts += [F.count_if(price < limit).alias(f"{name}_below")]
        counts += [F.count_if(price <= limit).alias(f"{name}_upto")]
        # Three times the error that one in a hundred exceeds: a rerun does not fail by chance.
        slack = size * (3 * sketches.rank_error()) + 1
        fits = (F.col(f"{name}_below") <= p * size + slack) & (F.col(f"{name}_upto") >= p * size - slack)
        checks += [fits.alias(f"{name}_within")]
    names = ["tier", *exact, *index.BEST_VALUE]
    return prices.groupBy(*names).agg(*counts).select(*names, *checks)


@register
def q54_exact_deviation(spark, sf_dir):
    """Deviations to the last digits, whichever way the rows are dealt out."""
    lines = b.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    keys = ["l_returnflag", "l_linestatus"]
    found = [
        lines.repartition(n, *by).groupBy(*keys).agg(deviation("l_extendedprice").alias(f"d{n}"))
        for n, by in ((3, []), (5, ["l_extendedprice"]))
    ]
    counted = lines.groupBy(*keys, "l_extendedprice").agg(F.count("*").alias("n"))
    weighed = counted.groupBy(*keys).agg(deviation("l_extendedprice", "n").alias("deviation"))
    same = (F.col("d3") == F.col("deviation")) & (F.col("d5") == F.col("deviation"))
    joined = weighed.join(found[0], keys).join(found[1], keys)
    return joined.select(*keys, F.round("deviation", 6).alias("deviation"), same.alias("same"))


@register
def q55_partwise_latest(spark, sf_dir):
    """Latest rows kept in parts, after loads of one part of the nations each."""
    target = f"{work_dir(spark, 'parts')}/latest"
    # Joined once and written: each load reads its rows twice, and a join of its own each time
    # would send the parts and suppliers through the driver again.
    found = b.quotes(spark, sf_dir).withColumn("load", F.quarter("ingested_at"))
    quotes = tables.settle(found, "quotes")
    for load in range(1, 5):
        advance_parts(quotes.where(F.col("load") == load), target, parts=16)
    return latest_rows(spark, target)


def both_catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogs.union_providers(
        catalogs.flatten_terms(b.products(spark, sf_dir), b.terms(spark, sf_dir), "us-east-1"),
        catalogs.flatten_pages(b.pages(spark, sf_dir), ref.B_REGIONS),
    )


@register
def q56_payload_variant(spark, sf_dir):
    """Every payload field of both catalogues, found without a schema, as a typed column."""
    rows = tables.settle(both_catalogues(spark, sf_dir), "catalogues")
    fields = catalogs.payload_fields(rows)
    named = {re.sub(r"\W", "", path): (path, kind) for path, kind in fields.items()}
    found = catalogs.with_payload_fields(rows.select("provider", "raw_payload"), named)
    return found.drop("raw_payload")


@register
def q57_kept_inventory(spark, sf_dir):
    """Files with their rows and times, from one kept table of rows per load."""
    quotes = b.quotes(spark, sf_dir).withColumn("load", F.year("ingested_at"))
    return profile.inventory_of(tables.settle(profile.load_inventory(quotes), "inventory"))


@register
def q58_kept_regions(spark, sf_dir):
    """Rows per region, and whether the merged sketches' number of files is within 5 %."""
    quotes = b.quotes(spark, sf_dir).withColumn("load", F.year("ingested_at"))
    found = profile.regions_of(tables.settle(profile.load_regions(quotes), "regions"))
    counted = profile.region_pages(quotes).select("region", F.col("files").alias("counted"))
    gap = F.abs(F.col("files") - F.col("counted"))
    return found.join(counted, "region").select(
        "region", "n", "counted", (gap <= F.col("counted") * 0.05).alias("within")
    )


@register
def q59_bucketed_terms(spark, sf_dir):
    """Catalogue A from tables in buckets by SKU, which join without a shuffle."""
    names = [f"quotegrid_{name}_{uuid.uuid4().hex}" for name in ("products", "terms")]
    for name, frame in zip(names, (b.products, b.terms), strict=True):
        tables.write_bucketed(frame(spark, sf_dir), name, "sku", 8)
    rows = catalogs.flatten_terms(spark.table(names[0]), spark.table(names[1]), "us-east-1")
    return rows.select(*CATALOG_COLUMNS, "unit_text", "vcpu", "memory_gb")


@register
def q60_namespace(spark, sf_dir):
    """A namespace made twice without error, a table in it replaced by its own rows."""
    name = f"quotegrid_{uuid.uuid4().hex}"
    for _ in range(2):
        tables.ensure_database(spark, name)
    events = b.table(spark, sf_dir, "events").select("event_id", "event_type")
    tables.replace(events, f"{name}.events")
    purchases = spark.table(f"{name}.events").where(F.col("event_type") == "purchase")
    tables.replace(purchases, f"{name}.events")
    return spark.table(f"{name}.events")


@register
def q61_empty_batches(spark, sf_dir):
    """Batches of events by type, one of them without a row: landed or not, and lines there."""
    events, root = b.table(spark, sf_dir, "events"), work_dir(spark, "batches")
    found = []
    for kind in ("purchase", "error", "none such"):
        batch = events.where(F.col("event_type") == kind).select("event_id", "event_type")
        landed = land(batch, f"{root}/{kind.replace(' ', '-')}")
        lines = spark.read.text(f"{root}/{kind.replace(' ', '-')}").agg(F.count("*").alias("lines"))
        found.append(lines.select(F.lit(kind).alias("kind"), F.lit(landed).alias("landed"), "lines"))
    return catalogs.union_providers(*found)
