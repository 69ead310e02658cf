"""JSON landing zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Full microseconds on both ways; the writer's default would cut them to milliseconds.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def land(df: DataFrame, path: str) -> bool:
    """Append ``df`` as JSON lines to ``path``; False if the batch had no row.

    The batch is computed once. An empty one leaves the folder, and no line in it.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").options(**JSON_OPTIONS).json(path)
    return seen.get["rows"] > 0


def discover_schema(spark: SparkSession, path: str, sampling: float = 1.0) -> T.StructType:
    """Schema inferred from all landed files, to compare with the declared one."""
    reader = spark.read.options(**JSON_OPTIONS).option("recursiveFileLookup", "true")
    return reader.option("samplingRatio", sampling).json(path).schema
