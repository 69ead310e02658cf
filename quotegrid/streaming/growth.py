"""Columns that turn up later: found in rescued fields, kept as versions of the Bronze schema.

A drain rescues the fields that its schema lacks. Their types are inferred over all rescued
rows of the load by one mergeable aggregate, and new names become a version in a small table.
The next drain reads that version, from then on the fields are typed columns; rows loaded before
keep theirs rescued and have null. A column keeps the type it got: a value that does not fit it
stays rescued, so growth never loses a value or a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotegrid.functions.variants import as_json, column_kind, inferred
from quotegrid.schemas import BRONZE, LOAD, RESCUED
from quotegrid.sources.tables import append, exists, read

#: One row per promoted column; a load that brought none has one without a name.
VERSIONS = T.StructType(
    [
        T.StructField("version", T.IntegerType()),
        T.StructField(LOAD, T.IntegerType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("kind", T.StringType()),
    ]
)


def rescued_types(bronze: DataFrame) -> dict[str, T.DataType]:
    """Column types of all fields among the rescued ones, by name.

    A rescued value is text; what reads as JSON of another type counts as that. The aggregate
    merges the types of rows before the shuffle; its result is one text.
    """
    fields = F.from_json(RESCUED, "map<string,string>")
    rows = bronze.where(F.col(RESCUED).isNotNull()).select(
        F.to_variant_object(F.transform_values(fields, lambda _, v: as_json(v))).alias("fields")
    )
    found = rows.agg(F.schema_of_variant_agg("fields")).first()[0]
    kind = inferred(found)
    if not isinstance(kind, T.StructType):  # no rescued field at all
        return {}
    kinds = {f.name: column_kind(f.dataType) for f in kind.fields}
    return {name: kind for name, kind in sorted(kinds.items()) if kind is not None}


def promoted_columns(spark: SparkSession, versions: str) -> T.StructType:
    """The columns of the newest schema version, beyond the declared ones."""
    if not exists(spark, versions):
        return T.StructType()
    rows = read(spark, versions, VERSIONS).where(F.col("name").isNotNull()).collect()
    first: dict[str, T.DataType] = {}
    for row in sorted(rows, key=lambda r: (r.version, r.place)):
        first.setdefault(row["name"], T.DataType.fromDDL(row["kind"]))
    return T.StructType([T.StructField(name, kind) for name, kind in first.items()])


def bronze_schema(
    spark: SparkSession, versions: str | None, declared: T.StructType = BRONZE
) -> T.StructType:
    """``declared`` with the promoted columns before the partition column."""
    grown = promoted_columns(spark, versions) if versions else T.StructType()
    return T.StructType([*declared.fields, *(f for f in grown if f.name not in declared.names)])


def grow(spark: SparkSession, bronze: DataFrame, versions: str) -> T.StructType:
    """Make new columns of the fields rescued since the last look; all promoted columns.

    Only loads after the last one looked at are read, and of those only the rescued fields. A
    run that dies before its version is written is made up for by the next one, and a version
    written twice counts once. Names differ from existing ones in more than case.
    """
    seen, number = None, 0
    if exists(spark, versions):
        seen, number = read(spark, versions, VERSIONS).agg(F.max(LOAD), F.max("version")).first()
    news = bronze if seen is None else bronze.where(F.col(LOAD) > F.lit(seen))
    newest = news.agg(F.max(LOAD)).first()[0]
    if newest is None:
        return promoted_columns(spark, versions)
    known = {f.name.lower() for f in promoted_columns(spark, versions)}
    known |= {c.lower() for c in bronze.columns}
    rows: list[tuple] = []
    for name, kind in rescued_types(news).items():
        if name.lower() not in known:
            known.add(name.lower())
            rows.append(((number or 0) + 1, newest, len(rows), name, kind.simpleString()))
    rows = rows or [(number or 0, newest, 0, None, None)]
    append(spark.createDataFrame(rows, VERSIONS).coalesce(1), versions)
    return promoted_columns(spark, versions)
