"""Grouped checks and summaries (all partial-aggregated before the shuffle)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def distinct_tuples(df: DataFrame, cols: list) -> DataFrame:
    """Distinct attribute tuples; NULLs compare equal."""
    return df.select(*cols).distinct()


def coverage_by(df: DataFrame, group, resolved_col: str) -> DataFrame:
    """Rows, resolved rows and ``100 * resolved / rows`` (1 decimal) per group."""
    return (df.groupBy(*_keys(group))
              .agg(F.count(F.lit(1)).alias("rows"), F.count(resolved_col).alias("resolved"))
              .withColumn("coverage_pct",
                          F.round(F.col("resolved").cast("decimal(20,0)") * 100 / F.col("rows"), 1)))


def control_totals(df: DataFrame, doc_col: str, weight_kg_col: str) -> DataFrame:
    """Rows, distinct source documents, tonnes to 3 decimals."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(doc_col).alias("docs"),
                  F.round(F.sum(weight_kg_col) / 1000, 3).alias("tons"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys present more than once (NULL keys group together)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_audit(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Per table: rows, distinct keys and their difference, unioned."""
    parts = []
    for name, df in tables.items():
        k = _keys(keys[name])
        key = F.struct(*k) if len(k) > 1 else F.col(k[0])
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"),
                            F.count_distinct(key).alias("distinct_keys"))
                       .select(F.lit(name).alias("table_name"), "rows", "distinct_keys",
                               (F.col("rows") - F.col("distinct_keys")).alias("duplicates")))
    return reduce(DataFrame.unionByName, parts)


def with_total_row(df: DataFrame, label_col: str, measures: list[Column], total_label: str = "TOTAL") -> DataFrame:
    """Groups of ``label_col`` and a total row, by one rollup: the rows are read
    and pre-aggregated once.  A NULL label is a group of its own, not the total."""
    rolled = df.rollup(label_col).agg(F.grouping(label_col).alias("__total"), *measures)
    label = F.when(F.col("__total") == 1, F.lit(total_label)).otherwise(F.col(label_col))
    return rolled.withColumn(label_col, label).drop("__total")


def share_of_total(grouped: DataFrame, measure: str, share_col: str = "share") -> DataFrame:
    """Each group's share of the grand total, for an already grouped (small)
    result: one global window over the group rows, never over the facts."""
    m = F.col(measure).cast("double")
    total = F.sum(m).over(Window.partitionBy())
    return grouped.withColumn(share_col, m / total)


def count_if(cond: Column) -> Column:
    return F.count_if(cond)
