"""Registry plumbing: query callables, their SQL oracles, output typing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from fieldbook.registry.standins import Tables, standin_cte

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Engine-neutral output types: dates/timestamps as ISO text, decimals as
    double (exact sums converted once at the end)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, standins: list[str] | None = None, sql: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name`` with its oracle
    (``standins`` are prepended as a WITH clause)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Tables(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = (standin_cte(standins) if standins else "") + sql
        return fn
    return deco
