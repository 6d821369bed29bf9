"""Top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Global top-n: ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject
    (per-partition top-n, then a merge of n x partitions rows)."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, group, order: list[Column], n: int, rank_col: str = "rank") -> DataFrame:
    """Top-n inside each group; ``row_number <= n`` gets a partial group limit
    before the shuffle."""
    g = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*g).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
