"""Hand-written quotes."""

import datetime as dt
import math

from pyspark.sql import functions as F

from quotegrid.schemas import LANDING, LOAD_COLUMNS

T0 = dt.datetime(2026, 3, 1, 6)
T1 = dt.datetime(2026, 3, 2, 6)

DEFAULTS = {
    "provider": "AWS",
    "instance_type": "p3.2xlarge",
    "hw_type": "V100",
    "region": "us-east-1",
    "price_per_hour": 3.06,
    "price_type": "on_demand",
    "tier": "Fine-tuning",
    "ingested_at": T0,
    "source_file": "f1",
}


def bronze(spark, *rows):
    schema = type(LANDING)([*LANDING.fields, *LOAD_COLUMNS.fields])
    filled = [{**DEFAULTS, **row} for row in rows]
    return spark.createDataFrame([[r.get(n) for n in schema.names] for r in filled], schema)


def silver(spark, *rows):
    """Rows of (tier, provider, instance, unit price[, overrides])."""
    full = []
    for tier, provider, instance, price, *more in rows:
        full.append(
            {
                "tier": tier,
                "provider": provider,
                "instance_type": instance,
                "price_per_hour": price,
                **(more[0] if more else {}),
            }
        )
    return bronze(spark, *full).withColumn("unit_price", F.col("price_per_hour"))


def rows_of(df):
    """Rows as a sorted list of tuples with NaN and null comparable."""

    def plain(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else str(v)

    names = sorted(df.columns)
    return sorted(tuple(plain(r[n]) for n in names) for r in df.collect())
