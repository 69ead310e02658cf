"""Index history replayed from raw quotes, by signed changes.

A quote stands from its month to the month in which the next one of its key replaces it. Each
becomes +1 in the first month and -1 in the last, counted per tier, provider, price and month;
no row is made per key and month. Running sums of the changes over the months are the counts that
a run at each month end would have found, and what the index needs follows from them:

* counts, means and deviations are running sums of exact decimals per tier;
* the changes are cut into small ranges of prices, whose running counts tell which range holds a
  quantile's rank at a month end; only that range's changes are summed up to it;
* the best value is the least of the quotes at the floor, by (price, first month, last month).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotegrid.functions.scalars import EXACT, POWER_SUMS, deviation_of, mean_of, power_sums
from quotegrid.operators.index import (
    BEST_VALUE,
    INDEX_COLUMNS,
    PICK_ORDER,
    PRICE,
    median_column,
    spread_columns,
    with_spreads,
)
from quotegrid.operators.joins import join_groups
from quotegrid.operators.latest import QUOTE_KEYS, latest_per_key
from quotegrid.operators.quantiles import QUARTILES
from quotegrid.reference_data import PROVIDERS
from quotegrid.sources.tables import settle

#: Changes per range of prices; equal prices stay together.
RANGE_ROWS = 1_024
FIRST, AFTER, MONTH = "first_month", "after_month", "index_month"


def standing_quotes(
    bronze: DataFrame, keys: Sequence[str] = QUOTE_KEYS
) -> DataFrame:
    """The quotes known at some month end, with the months for which they stand.

    That is the latest row per key and month with a quote, from ``first_month`` on, up to but
    not including ``after_month``, the key's next month with one (null: to the end). A key has
    at most one row per month whatever its number of quotes.
    """
    monthly = latest_per_key(
        bronze.withColumn(FIRST, F.trunc("ingested_at", "month")), [*keys, FIRST]
    )
    return monthly.withColumn(AFTER, F.lead(FIRST).over(Window.partitionBy(*keys).orderBy(FIRST)))


def quotes_at(standing: DataFrame, month: Column) -> DataFrame:
    """The quotes that stand at the end of the month that begins with ``month``."""
    known = (F.col(FIRST) <= month) & (F.col(AFTER).isNull() | (F.col(AFTER) > month))
    return standing.where(known).drop(FIRST, AFTER)


def month_end_quotes(
    bronze: DataFrame, keys: Sequence[str] = QUOTE_KEYS, last: Column | None = None
) -> DataFrame:
    """For each month end the latest row per key known by then, as ``index_month``.

    One row per key and month: for results that have no running form; ``month_end_gold`` needs
    none. The series ends in the month of ``last``, by default the newest time in ``bronze``.
    """
    last = bronze.agg(F.max("ingested_at")).scalar() if last is None else last
    until = F.coalesce(F.add_months(AFTER, -1), F.trunc(last, "month"))
    each_month = F.sequence(FIRST, until, F.expr("interval 1 month"))
    return standing_quotes(bronze, keys).withColumn(MONTH, F.explode(each_month)).drop(FIRST, AFTER)


def month_end_index(
    quotes: DataFrame, index: Callable[[DataFrame, Sequence[str]], DataFrame]
) -> DataFrame:
    """Index rows of every month end, dated with the last day of the month.

    ``quotes`` are clean ``month_end_quotes``, which ``index`` aggregates by the given keys.
    """
    rows = index(quotes, [MONTH, "tier"])
    date = F.last_day(MONTH)
    return rows.withColumns(
        {"index_date": date, "index_timestamp": date.cast("timestamp_ntz")}
    ).drop(MONTH)


def _changes(standing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed counts per group, provider, price and month."""
    signs = F.array(
        F.struct(F.col(FIRST).alias(MONTH), F.lit(1).alias("sign")),
        F.struct(F.col(AFTER).alias(MONTH), F.lit(-1).alias("sign")),
    )
    events = standing.select(*keys, "provider", PRICE, F.explode(signs).alias("event"))
    counted = events.where("event.index_month IS NOT NULL").groupBy(
        *keys, "provider", PRICE, F.col("event.index_month").alias(MONTH)
    )
    return counted.agg(F.sum("event.sign").alias("_n")).where("_n <> 0")


def _each_month(groups: DataFrame, last: Column) -> DataFrame:
    """One row per group and month, from the group's first month to ``last``."""
    months = F.sequence(MONTH, F.trunc(last, "month"), F.expr("interval 1 month"))
    return groups.where(F.col(MONTH) <= last).withColumn(MONTH, F.explode(months))


def _running(sums: DataFrame, keys: Sequence[str], columns: Sequence[str], last: Column) -> DataFrame:
    """Sums per group and month of change -> running sums at the end of every month."""
    begin = sums.groupBy(*keys).agg(F.min(MONTH).alias(MONTH))
    rows = join_groups(_each_month(begin, last), sums, [*keys, MONTH])
    upto = Window.partitionBy(*keys).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(*keys, MONTH, *[F.sum(c).over(upto).alias(c) for c in columns])


def _moments(changes: DataFrame, keys: Sequence[str], last: Column) -> DataFrame:
    """Sample size, mean and deviation per group and month."""
    exact = F.col(PRICE).try_cast(EXACT)
    counts = F.when(exact.isNotNull(), F.col("_n")).cast("decimal(14,0)")
    sums = {
        "_rows": F.sum("_n"),
        "_priced": F.sum(counts),
        "_total": F.sum(exact * counts),
        **power_sums(PRICE, "_n"),
    }
    summed = changes.groupBy(*keys, MONTH).agg(*[c.alias(n) for n, c in sums.items()])
    rows = _running(summed, keys, list(sums), last).where("_rows > 0")
    return rows.select(
        *keys,
        MONTH,
        mean_of(F.col("_total"), F.nullif("_priced", F.lit(Decimal(0)))).alias("index_mean"),
        F.round(deviation_of({n: F.col(n) for n in POWER_SUMS}), 4).alias("index_stddev"),
        F.col("_rows").alias("sample_size"),
    )


def _ranges(changes: DataFrame, group: Sequence[str]) -> DataFrame:
    """Changes with the number of their range of prices, ascending within a group, written once.

    Spark's own ranges are cut further by rank within each, so one holds ``RANGE_ROWS`` changes
    or those of a single price.
    """
    dealt = changes.repartitionByRange(*group, PRICE).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part", *group).orderBy(PRICE)
    cut = F.floor((F.rank().over(inside) - 1) / RANGE_ROWS)
    return settle(dealt.withColumn("_cut", cut), "price-ranges")


def _quantiles(
    changes: DataFrame, group: Sequence[str], ranks: dict[str, Column], last: Column
) -> DataFrame:
    """Per group and month end the price at each rank; ``ranks`` are columns over ``_all``."""
    group = list(group)
    ranges = _ranges(changes.where(F.col(PRICE).isNotNull()), group)
    unit = [*group, "_part", "_cut"]
    counts = ranges.groupBy(*unit, MONTH).agg(F.sum("_n").alias("_n"))
    counts = _running(counts, unit, ["_n"], last).where("_n > 0")
    at_month = Window.partitionBy(*group, MONTH)
    upto = at_month.orderBy("_part", "_cut").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumns(
        {"_upto": F.sum("_n").over(upto), "_all": F.sum("_n").over(at_month)}
    )
    wanted = F.array(
        *[F.struct(F.lit(n).alias("name"), r.cast("bigint").alias("rank")) for n, r in ranks.items()]
    )
    before = F.col("_upto") - F.col("_n")
    targets = counts.withColumn("_want", F.explode(wanted)).where(
        (F.col("_want.rank") > before) & (F.col("_want.rank") <= F.col("_upto"))
    )
    targets = targets.select(
        *unit, F.col(MONTH).alias("_at"), F.col("_want.name").alias("_name"),
        (F.col("_want.rank") - before).alias("_rank"),
    )
    summed = (
        join_groups(targets, ranges, unit, "inner")
        .where(F.col(MONTH) <= F.col("_at"))
        .groupBy(*unit, "_at", "_name", "_rank", PRICE)
        .agg(F.sum("_n").alias("_n"))
    )
    ordered = Window.partitionBy(*unit, "_at", "_name").orderBy(PRICE)
    summed = summed.withColumn(
        "_upto", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    ).where(F.col("_upto") >= F.col("_rank"))
    return (
        summed.groupBy(*group, F.col("_at").alias(MONTH))
        .pivot("_name", list(ranks))
        .agg(F.min(PRICE))
    )


def _share(p: float) -> Column:
    """The rank of a quantile, in decimals like ``histogram_quantiles``."""
    return F.greatest(
        F.ceil(F.col("_all").cast("decimal(20,0)") * F.lit(Decimal(str(p)))), F.lit(1)
    )


def _best(standing: DataFrame, floors: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The cheapest standing quote per group and month, ties as in ``best_value``.

    Of the quotes at a floor price only the first of each pair of months is kept before months
    are looked at, so a price that very many quotes share costs no more than the months squared.
    """
    keys = list(keys)
    order = [x for c in PICK_ORDER for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    at_floor = floors.select(*keys, F.col(PRICE)).distinct()
    candidates = join_groups(standing, at_floor, [*keys, PRICE], "left_semi")
    firsts = candidates.groupBy(*keys, PRICE, FIRST, AFTER).agg(F.min(F.struct(*order)).alias("_best"))
    picked = (
        join_groups(floors, firsts, [*keys, PRICE], "inner")
        .where((F.col(FIRST) <= F.col(MONTH)) & (F.col(AFTER).isNull() | (F.col(AFTER) > F.col(MONTH))))
        .groupBy(*keys, MONTH)
        .agg(F.min("_best").alias("_best"))
    )
    named = [F.col("_best").getField(source).alias(name) for name, source in BEST_VALUE.items()]
    return picked.select(*keys, MONTH, *named)


def month_end_gold(
    standing: DataFrame,
    last: Column,
    providers: Sequence[str] = PROVIDERS,
    base: str | None = None,
    keys: Sequence[str] = ("tier",),
) -> DataFrame:
    """Gold rows of every month end to the month of ``last``, dated with the month's last day.

    ``standing`` are clean ``standing_quotes`` with a unit price, a table or cheap to read twice.
    """
    keys, base = list(keys), base or providers[0]
    changes = settle(_changes(standing, keys), "changes")
    position = F.array_position(F.array(*[F.lit(p) for p in providers]), F.col("provider"))
    scopes = F.array(F.lit(0).cast("bigint"), F.nullif(position, F.lit(0)))
    scoped = changes.withColumn("_scope", F.explode(scopes)).where("_scope IS NOT NULL")
    scoped = scoped.groupBy(*keys, "_scope", PRICE, MONTH).agg(F.sum("_n").alias("_n"))
    ranks = {name: _share(p) for name, p in QUARTILES.items()}
    ranks |= {"_floor": F.lit(1), "_ceiling": F.col("_all")}
    quantiles = settle(_quantiles(scoped, [*keys, "_scope"], ranks, last), "month-quantiles")

    def in_scope(scope: int, name: str, alias: str) -> Column:
        return F.max(F.when(F.col("_scope") == scope, F.col(name))).alias(alias)

    prices = quantiles.groupBy(*keys, MONTH).agg(
        *[in_scope(0, name, name) for name in (*QUARTILES, "_floor", "_ceiling")],
        *[in_scope(i, "index_median", median_column(p)) for i, p in enumerate(providers, 1)],
    )
    rows = join_groups(_moments(changes, keys, last), prices, [*keys, MONTH])
    rows = rows.withColumns(
        {"price_floor": F.round("_floor", 4), "price_ceiling": F.round("_ceiling", 4)}
    )
    rows = settle(rows, "month-index")
    floors = rows.select(*keys, MONTH, F.col("_floor").alias(PRICE))
    rows = join_groups(rows, _best(standing, floors, keys), [*keys, MONTH])
    date = F.last_day(MONTH)
    medians = [median_column(p) for p in providers]
    spreads = [c for p in providers if p != base for c in spread_columns(p, len(providers))]
    return with_spreads(rows, providers, base).select(
        *keys,
        *INDEX_COLUMNS,
        *medians,
        *spreads,
        *BEST_VALUE,
        date.alias("index_date"),
        date.cast("timestamp_ntz").alias("index_timestamp"),
    )
