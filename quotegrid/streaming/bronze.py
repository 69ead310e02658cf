"""Landed JSON files -> append-only Bronze table, each file once."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid.functions.variants import typed
from quotegrid.schemas import CORRUPT, LANDING, LOAD, RESCUED
from quotegrid.sources.landing import JSON_OPTIONS
from quotegrid.sources.tables import add_columns, append, exists, is_path, read

#: Older than any file can be: the stream must not skip a file for its old time.
ANY_AGE = "365000d"


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType = LANDING,
    max_bytes_per_trigger: int | None = 256 << 30,
    load: int | None = None,
    loaded_at: dt.datetime | None = None,
    archive: str | None = None,
    promoted: T.StructType | None = None,
) -> DataFrame:
    """File stream over all sub-folders of ``path``, with load number, load time and source file.

    Lines that do not fit ``schema`` keep their text in ``_corrupt_record``, and fields that
    ``schema`` lacks are kept as JSON in ``_rescued_data``, so a column that appears later is
    not lost. ``promoted`` columns (see ``growth``) are typed but never make a line corrupt: a
    value of another type stays rescued. A line is parsed once; only one with fields to rescue
    is parsed again.

    All rows of a drain have one load time. A long backlog is drained in batches of about
    ``max_bytes_per_trigger``. Files count whatever their age, so the stream remembers each
    one; with ``archive`` loaded files move there, which keeps listings short.
    """
    names = [f for f in schema.names if f != CORRUPT]
    grown = [f for f in promoted or () if f.name not in names]
    declared = T.StructType(
        [
            *(schema[n] for n in names),
            *(T.StructField(f.name, T.VariantType()) for f in grown),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
    reader = (
        spark.readStream.option("recursiveFileLookup", "true").option("maxFileAge", ANY_AGE)
    )
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    options = {**JSON_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # Names that no field has: a new column's name must not hide the line itself.
    line, row = f"_line_{uuid.uuid4().hex}", f"_row_{uuid.uuid4().hex}"
    lines = reader.text(path).where(F.trim("value") != "")
    parsed = lines.select(
        F.col("value").alias(line),
        F.from_json("value", declared, options).alias(row),
        F.lit(load).cast("int").alias(LOAD),
        F.lit(loaded_at or dt.datetime.now(dt.timezone.utc)).alias("ingested_at"),
        F.col("_metadata.file_path").alias("source_file"),
    )
    field = lambda f: F.col(row).getField(f.name)
    values = {f.name: typed(field(f), f.dataType) for f in grown}
    known = F.array(*[F.lit(n) for n in (*names, *values)]).cast("array<string>")
    rescued = F.array_except(F.json_object_keys(line), known)
    for f in grown:
        given = field(f).isNotNull() & ~F.is_variant_null(field(f))
        misfit = F.when(given & values[f.name].isNull(), F.array(F.lit(f.name)))
        rescued = F.concat(rescued, F.coalesce(misfit, F.array().cast("array<string>")))
    whole = F.from_json(line, "map<string,string>")
    kept = F.to_json(F.map_filter(whole, lambda name, _: F.array_contains(rescued, name)))
    return parsed.select(
        *[F.col(row).getField(n).alias(n) for n in (*names, CORRUPT)],
        *[value.alias(name) for name, value in values.items()],
        F.when(F.size(rescued) > 0, kept).alias(RESCUED),
        LOAD,
        "ingested_at",
        "source_file",
    )


def next_load(spark: SparkSession, bronze: str) -> int:
    """The number of the next load, one above the largest in Bronze; no clock is involved."""
    if not exists(spark, bronze):
        return 1
    return (read(spark, bronze).agg(F.max(LOAD)).first()[0] or 0) + 1


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows); the good ones lose the marker column."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull())


#: Rows of a load as the load itself counted them; the rescued ones are among the loaded.
COUNTS = ["loaded", "quarantined", "rescued"]
#: Progress reports that a drain may ask for afterwards, one per batch.
MAX_BATCHES = 100_000


def drain(
    stream: DataFrame, out: str, checkpoint: str, promoted: T.StructType | None = None
) -> dict[str, int]:
    """Append everything available to ``out`` (folder or table name), by load, then stop.

    The checkpoint, on shared storage, remembers the files already loaded. The result counts
    the good, quarantined and rescued rows, observed while they were written: no second scan.
    A table of the catalogue first gets the ``promoted`` columns that it lacks.
    """
    spark = stream.sparkSession
    if promoted:
        add_columns(spark, out, promoted)
    bad = F.col(CORRUPT).isNotNull()
    counted = stream.observe(
        "load_counts",
        F.count_if(~bad).alias("loaded"),
        F.count_if(bad).alias("quarantined"),
        F.count_if(~bad & F.col(RESCUED).isNotNull()).alias("rescued"),
    )
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(MAX_BATCHES))
    try:
        writer = (
            counted.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .partitionBy(LOAD)
            .trigger(availableNow=True)
        )
        query = writer.start(out) if is_path(out) else writer.toTable(out)
        query.awaitTermination()
        batches = {p.batchId: p.observedMetrics.get("load_counts") for p in query.recentProgress}
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    return {name: sum(row[name] for row in batches.values() if row) for name in COUNTS}


LOADS = T.StructType(
    [T.StructField(LOAD, T.IntegerType()), *(T.StructField(c, T.LongType()) for c in COUNTS)]
)


def note_load(spark: SparkSession, loads: str, load: int, counts: dict[str, int]) -> None:
    """Add a load's counts to the table of loads; a drain without rows is no load."""
    if any(counts.values()):
        row = (load, *(counts[c] for c in COUNTS))
        append(spark.createDataFrame([row], LOADS).coalesce(1), loads)


def load_counts(spark: SparkSession, loads: str, bronze: str) -> DataFrame:
    """Rows per load: as noted, or counted in the load's own folder where a run died before.

    A load number is noted at most once, as it counts up from Bronze itself.
    """
    noted = read(spark, loads, LOADS) if exists(spark, loads) else spark.createDataFrame([], LOADS)
    known = {r[LOAD] for r in noted.select(LOAD).collect()}
    missing = [n for n in range(1, next_load(spark, bronze)) if n not in known]
    if not missing:
        return noted
    bad = F.col(CORRUPT).isNotNull()
    found = read(spark, bronze, merge=True).where(F.col(LOAD).isin(missing)).groupBy(LOAD).agg(
        F.count_if(~bad).alias("loaded"),
        F.count_if(bad).alias("quarantined"),
        F.count_if(~bad & F.col(RESCUED).isNotNull()).alias("rescued"),
    )
    return noted.unionByName(found)
