"""Guarded ratios (norm completion, yield, productivity)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_completion_pct(work, norm) -> Column:
    """``round(100 * work / norm, 1)`` when the norm is positive, else NULL."""
    w, n = _c(work), _c(norm)
    return F.when(n > 0, F.round(w * F.lit(100) / n, 1))


def ratio_of_sums_pct(sum_work: Column, sum_norm: Column) -> Column:
    """KPI form: a ratio of sums, never a mean of row ratios."""
    return F.when(sum_norm > 0, F.round(sum_work * F.lit(100) / sum_norm, 1))


def guarded_ratio(num, den, precision: int, scale: int, num_scale: int = 1) -> Column:
    """``(num / num_scale) / den`` rounded to the decimal type; NULL when den is NULL or 0."""
    n, d = _c(num), _c(den)
    q = (n / F.lit(num_scale)) / d if num_scale != 1 else n / d
    return F.when(d.isNotNull() & (d != 0), q.cast(DecimalType(precision, scale)))


def yield_t_ha(weight_kg, area_ha) -> Column:
    return guarded_ratio(weight_kg, area_ha, 10, 2, num_scale=1000)


def productivity_kg_h(weight_kg, hours) -> Column:
    return guarded_ratio(weight_kg, hours, 12, 2)
