"""Flights from a landed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.columns import marked
from skytally.sources.schema import BAD_LINE, FLIGHT_SCHEMA


def read_landed(spark: SparkSession, path: str, *, keep_bad: bool = False) -> DataFrame:
    """Flights written by ``sinks.land_flights``. Reports read only their columns of it, and a filter on ``year`` skips
    the folders of other years."""
    fields = [*FLIGHT_SCHEMA.fields, T.StructField("year", T.IntegerType())]
    if keep_bad:
        fields.append(T.StructField(BAD_LINE, T.StringType()))
    landed = spark.read.schema(T.StructType(fields)).parquet(path)
    return landed.select(*[marked(F.col(c), c) if c == "year" else F.col(c) for c in landed.columns])
