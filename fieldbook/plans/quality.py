"""Data-quality checks.  Each returns a DataFrame of violations (or a
one-row summary); what counts as error or warning is decided by the caller
(``enforce``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.aggregates import duplicate_keys
from fieldbook.operators.joins import anti_join


class QualityError(RuntimeError):
    pass


def load_counts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Documents and lines of one load (two aggregates, one row)."""
    n_lines = lines.agg(F.count(F.lit(1))).scalar()
    return docs.agg(F.count(F.lit(1)).alias("docs")).select("docs", n_lines.alias("lines"))


def docs_without_lines(docs: DataFrame, lines: DataFrame, key: str = "_id", line_doc: str = "doc_id") -> DataFrame:
    """Documents loaded with zero lines (error when all of a load's docs are)."""
    return anti_join(docs, lines, [(key, line_doc)])


def empty_source(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables that returned no rows (warning)."""
    parts = [df.limit(1).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).where(F.col("rows") == 0)


def active_vs_total(catalog: DataFrame, deleted: str = "_deletionmark") -> DataFrame:
    """Total rows and active rows (``IS FALSE`` excludes NULL marks)."""
    return catalog.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(F.col(deleted) == F.lit(False)).alias("active"))


def orphan_lines(lines: DataFrame, headers: DataFrame, line_doc: str = "doc_id", key: str = "_id") -> DataFrame:
    return anti_join(lines, headers, [(line_doc, key)])


def duplicate_key_rows(df: DataFrame, keys) -> DataFrame:
    return duplicate_keys(df, keys)


def lookup_fanout(dim: DataFrame, key: str) -> DataFrame:
    """Lookup keys present more than once: a left join on them multiplies rows."""
    return duplicate_keys(dim.where(F.col(key).isNotNull()), [key])


def fk_violations(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Non-NULL foreign keys without a parent row."""
    return anti_join(child.where(F.col(fk).isNotNull()), parent, [(fk, pk)])


def null_violations(df: DataFrame, not_null: list[str]) -> DataFrame:
    """Per column: number of NULLs where NOT NULL is required (one pass)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    stack = ", ".join(f"'{c}', `{c}`" for c in not_null)
    return agg.selectExpr(f"stack({len(not_null)}, {stack}) AS (column_name, null_rows)")


def net_weight_mismatch(weighings: DataFrame, net="ves_netto_kg", gross="ves_brutto_kg", tare="ves_tary_kg") -> DataFrame:
    """Weighings where net <> gross - tare (NULLs skipped)."""
    return weighings.where(F.col(net) != F.col(gross) - F.col(tare))


def unit_mixing(df: DataFrame, group: list[str], unit: str) -> DataFrame:
    """Groups whose quantities span several units (must never be summed)."""
    return df.groupBy(*group).agg(F.count_distinct(unit).alias("units")).where(F.col("units") > 1)


def enrichment_fill(h: DataFrame) -> DataFrame:
    """How many harvest rows found their field, crop, item, sort and plot."""
    return h.agg(F.count(F.lit(1)).alias("rows"),
                 F.count("pole_id").alias("field_found"), F.count("kultura").alias("crop_found"),
                 F.count("nomenklatura_name").alias("item_found"), F.count("sort").alias("sort_found"),
                 F.count("uchastok_nomer").alias("plot_found"),
                 F.count_if(F.col("god_1c") != F.col("god_urozhaya")).alias("year_mismatch"))


def enforce(violations: DataFrame, what: str, severity: str = "error") -> int:
    """Count violations (a single number to the driver); raise on errors."""
    n = violations.count()
    if n and severity == "error":
        raise QualityError(f"{what}: {n} violation(s)")
    return n
