"""Manually maintained sheets (shift production, downtime) as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_sheet(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """Fixed schema, header row, no inference; malformed rows fail the read."""
    return (spark.read.schema(schema).option("header", True).option("sep", sep)
            .option("mode", "FAILFAST").csv(path))
