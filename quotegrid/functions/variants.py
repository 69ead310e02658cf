"""Types of JSON values, and values by type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def inferred(text: str) -> T.DataType:
    """The type that ``schema_of_variant_agg`` found, as an ordinary one."""
    return T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))


def column_kind(found: T.DataType) -> T.DataType | None:
    """The column type for an inferred JSON type; None where no value was seen.

    Fractions are doubles, whole numbers beyond a bigint exact decimals. Mixed, nested and
    other values are kept as text, nested ones as JSON.
    """
    if isinstance(found, T.NullType):
        return None
    if isinstance(found, T.DecimalType):
        return T.DoubleType() if found.scale else T.DecimalType(38, 0)
    if isinstance(found, T.FloatType):
        return T.DoubleType()
    if isinstance(found, (T.LongType, T.DoubleType, T.BooleanType)):
        return found
    return T.StringType()


def as_json(text: Column) -> Column:
    """A text as the JSON value that it reads as, else as itself."""
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def typed(value: Column, kind: T.DataType) -> Column:
    """A JSON value as a column of ``kind``; null where it is of another type.

    A text counts as what it reads as, as ``as_json`` has it.
    """
    seen, cast = F.schema_of_variant(value), F.try_variant_get(value, "$", kind.simpleString())
    if isinstance(kind, T.StringType):
        return F.when(seen == "STRING", cast).when(seen != "VOID", F.to_json(value))
    text = F.when(seen == "STRING", F.try_variant_get(value, "$", "string"))
    seen = F.when(text.isNull(), seen).otherwise(F.schema_of_variant(F.try_parse_json(text)))
    whole = (seen == "BIGINT") | seen.rlike(r"^DECIMAL\([0-9]+,0\)$")
    number = whole | (seen == "DOUBLE") | (seen == "FLOAT") | seen.startswith("DECIMAL")
    fits = {T.LongType: whole, T.DecimalType: whole, T.DoubleType: number}
    return F.when(fits.get(type(kind), seen == kind.simpleString().upper()), cast)
