"""Row filters over three-valued document flags and dashboard selectors.

Three NULL rules coexist in the source warehouse and are kept apart on
purpose:

* strict active     - ``posted AND NOT deleted``; a NULL flag drops the row
* tolerant deletion - NULL deletion mark counts as not deleted; posting ignored
* tolerant both     - NULL deleted -> false, NULL posted -> false
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.constants import UNRESOLVED_UNIT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_active_flag(posted="_posted", deleted="_deletionmark") -> Column:
    return (_c(posted) == F.lit(True)) & (_c(deleted) == F.lit(False))


def not_deleted_flag(deleted="_deletionmark") -> Column:
    return ~F.coalesce(_c(deleted), F.lit(False))


def tolerant_active_flag(posted="_posted", deleted="_deletionmark") -> Column:
    return not_deleted_flag(deleted) & F.coalesce(_c(posted), F.lit(False))


def strict_active(df: DataFrame, posted="_posted", deleted="_deletionmark") -> DataFrame:
    return df.where(strict_active_flag(posted, deleted))


def tolerant_not_deleted(df: DataFrame, deleted="_deletionmark") -> DataFrame:
    return df.where(not_deleted_flag(deleted))


def tolerant_active(df: DataFrame, posted="_posted", deleted="_deletionmark") -> DataFrame:
    return df.where(tolerant_active_flag(posted, deleted))


def dim_not_deleted(df: DataFrame, deleted="_deletionmark") -> DataFrame:
    """Dimension views: ``deleted = FALSE`` (a NULL mark drops the row)."""
    return df.where(_c(deleted) == F.lit(False))


def kind_equals(df: DataFrame, col, value) -> DataFrame:
    return df.where(_c(col) == F.lit(value))


def link_present(df: DataFrame, col) -> DataFrame:
    """Link present: not NULL (zero GUIDs are NULL after ``norm_guid``)."""
    return df.where(_c(col).isNotNull())


def positive(df: DataFrame, col) -> DataFrame:
    return df.where(_c(col) > 0)


def current_rows(df: DataFrame, flag="is_current") -> DataFrame:
    return df.where(_c(flag) == F.lit(True))


def safe_report_rows(df: DataFrame, resolved="is_nomenclature_resolved", unit="uom_name") -> DataFrame:
    """Rows fit for quantity reports: resolved item and a known unit (the
    movement view labels an unknown one)."""
    return df.where((_c(resolved) == F.lit(True)) & _c(unit).isNotNull() & (_c(unit) != UNRESOLVED_UNIT))


def apply_selectors(df: DataFrame, selectors: list[Column] | None) -> DataFrame:
    """Dashboard selectors (year, field, period, machine, ...) ANDed together."""
    if not selectors:
        return df
    return df.where(reduce(lambda a, b: a & b, selectors))
