"""Table reads and sinks, by path or by catalogue name."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid.session import work_dir


def is_path(target: str) -> bool:
    return "/" in target


def read(
    spark: SparkSession,
    target: str,
    schema: T.StructType | None = None,
    merge: bool = False,
) -> DataFrame:
    """A table by name, or a parquet folder.

    ``schema`` spares Spark the look into the files; ``merge`` unites the columns of all
    files, which reads every footer and is meant for the small snapshot table.
    """
    if not is_path(target):
        return spark.table(target)
    reader = spark.read.option("mergeSchema", str(merge).lower())
    return (reader.schema(schema) if schema else reader).parquet(target)


def exists(spark: SparkSession, target: str) -> bool:
    if not is_path(target):
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target)
    except AnalysisException as error:
        # A missing folder, or one without a data file; that one has no name of its own yet.
        if error.getCondition() not in ("PATH_NOT_FOUND", "_LEGACY_ERROR_TEMP_1134"):
            raise
        return False
    return True


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, name: str) -> None:
    """Create a namespace, of one part or as ``catalog.schema``."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(name)}")


def _save(writer: DataFrameWriter, target: str) -> None:
    if is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)


def append(df: DataFrame, target: str) -> None:
    _save(df.write.mode("append"), target)


def add_columns(spark: SparkSession, target: str, columns: T.StructType) -> None:
    """Add the columns that a table of the catalogue lacks; a folder takes any column."""
    if is_path(target) or not exists(spark, target):
        return
    held = {c.lower() for c in spark.table(target).columns}
    missing = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns if f.name.lower() not in held]
    if missing:
        spark.sql(f"ALTER TABLE {quoted(target)} ADD COLUMNS ({', '.join(missing)})")


def overwrite(df: DataFrame, target: str) -> None:
    """Replace rows and schema of ``target``, which ``df`` must not read from."""
    _save(df.write.mode("overwrite"), target)


def _store(spark: SparkSession, place: str) -> tuple:
    """Spark's own client of the store that holds ``place``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path, path(place).getFileSystem(spark._jsc.hadoopConfiguration())


def _forget(spark: SparkSession, home: str, keep: Sequence[str]) -> None:
    """Delete the row folders of a replaced table but those in ``keep``."""
    path, store = _store(spark, home)
    kept = {place.rpartition("/")[2] for place in keep}
    for entry in store.listStatus(path(home)):
        name = entry.getPath().getName()
        if re.fullmatch("rows-[0-9a-f]{32}", name) and name not in kept:
            store.delete(entry.getPath(), True)


def replace(df: DataFrame, target: str) -> None:
    """Replace rows and schema of ``target`` so that readers never find it missing.

    The rows are written beside it first; a write that dies leaves the old ones as they were.
    Then a table of the catalogue is pointed at the new place in one step of the catalogue, and
    a folder is exchanged by two renames of its store. A table's last rows stay where they were
    until the next time, for readers that have begun; ``df`` may read from ``target``.
    """
    spark = df.sparkSession
    if not is_path(target):
        if not spark.catalog.tableExists(target):
            return _save(df.write.mode("overwrite"), target)
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(target)}")
        place = described.where("col_name = 'Location'").first()["data_type"].rstrip("/")
        home = re.sub("/rows-[0-9a-f]{32}$", "", place)
        beside = f"{home}/rows-{uuid.uuid4().hex}"
        df.write.parquet(beside)
        kinds = {f.name: f.dataType for f in spark.table(target).schema}
        if kinds == {f.name: f.dataType for f in df.schema}:
            spark.sql(f"ALTER TABLE {quoted(target)} SET LOCATION '{beside}'")
            spark.catalog.refreshTable(target)
            _forget(spark, home, [beside, place])
        else:
            spark.sql(f"DROP TABLE {quoted(target)}")
            spark.catalog.createTable(target, beside, "parquet")
        return None
    beside = f"{target.rstrip('/')}-next-{uuid.uuid4().hex}"
    df.write.parquet(beside)
    gone = f"{target.rstrip('/')}-gone-{uuid.uuid4().hex}"
    path, store = _store(spark, target)
    if store.exists(path(target)):
        store.rename(path(target), path(gone))
    if not store.rename(path(beside), path(target)):
        raise OSError(f"{beside} could not become {target}")
    store.delete(path(gone), True)
    return None


def _part(target: str, name: str) -> str:
    return f"{target}/{name}" if is_path(target) else f"{target}_{name}"


def _kept_version(spark: SparkSession, target: str) -> int:
    log = _part(target, "log")
    return read(spark, log).agg(F.max("version")).first()[0] if exists(spark, log) else 0


def _slot(target: str, version: int) -> str:
    return _part(target, "odd" if version % 2 else "even")


def read_kept(spark: SparkSession, target: str) -> DataFrame | None:
    """What ``keep`` last completed, None before its first time."""
    version = _kept_version(spark, target)
    return read(spark, _slot(target, version)) if version else None


def keep(df: DataFrame, target: str) -> DataFrame:
    """Replace a kept state, which ``df`` may read, without ever losing the former one.

    Versions go to two places in turn, and one counts only once it is in the log; a write
    that dies half-way leaves the former version in force.
    """
    spark = df.sparkSession
    version = _kept_version(spark, target) + 1
    overwrite(df, _slot(target, version))
    entry = spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
    _save(entry.coalesce(1).write.mode("append"), _part(target, "log"))
    return read(spark, _slot(target, version))


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read from there.

    For a costly result that several branches of a plan read: it ends the lineage, and
    neither the branches nor a repeated task compute it again.
    """
    target = f"{work_dir(df.sparkSession, purpose)}/rows"
    overwrite(df, target)
    return read(df.sparkSession, target, df.schema)


def write_bucketed(df: DataFrame, name: str, column: str, buckets: int) -> None:
    """Write a table of the catalogue in buckets by ``column``, sorted within each.

    Two tables with equally many buckets join on that column without a shuffle.
    """
    dealt = df.repartition(buckets, column)  # one file per bucket
    dealt.write.mode("overwrite").bucketBy(buckets, column).sortBy(column).saveAsTable(name)


def overwrite_partitions(df: DataFrame, target: str, columns: Sequence[str]) -> None:
    """Replace the partitions by ``columns`` that occur in ``df`` and leave the others alone."""
    spark = df.sparkSession
    if not is_path(target) and spark.catalog.tableExists(target):
        # insertInto goes by position and by the table's own partitioning.
        names = spark.table(target).columns
        df.select(names).write.option("partitionOverwriteMode", "dynamic").insertInto(
            target, overwrite=True
        )
    else:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        _save(writer.partitionBy(*columns), target)


def write_snapshot(df: DataFrame, target: str, mode: str = "append") -> None:
    """Add one index snapshot, stored by ``index_date``.

    ``append`` keeps every run, also two of one day; ``replace_date`` replaces the dates
    that occur in ``df`` and leaves the others alone, so a rerun changes nothing.
    """
    df = df.hint("rebalance", "index_date")
    if mode == "append":
        _save(df.write.mode("append").partitionBy("index_date"), target)
    elif mode == "replace_date":
        overwrite_partitions(df, target, ["index_date"])
    else:
        raise ValueError(f"unknown snapshot mode {mode!r}")
