"""Calendar attributes of a day (dimension ``dim_date``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.constants import AGRO_PHASES, DAY_NAMES, MONTH_NAMES, SEASON_START_MONTH


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _label(names, idx: Column) -> Column:
    # element_at is 1-based, like the SQL array it replaces
    return F.element_at(F.array(*[F.lit(n) for n in names]), idx)


def harvest_year(c) -> Column:
    return F.year(_c(c))


def month_start(c) -> Column:
    return F.trunc(_c(c), "month")


def iso_weekday(c) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(_c(c)) + 1


def season(c) -> Column:
    d = _c(c)
    return F.when(F.month(d) >= SEASON_START_MONTH, F.year(d)).otherwise(F.year(d) - 1)


def season_label(c) -> Column:
    s = season(c)
    return F.concat(s.cast("string"), F.lit("-"), (s + 1).cast("string"))


def calendar_columns(day_col: str = "date_day") -> list[Column]:
    """All ``dim_date`` attributes of a date column, in table order."""
    d = F.col(day_col)
    return [
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        _label(MONTH_NAMES, F.month(d)).alias("month_name_ru"),
        F.weekofyear(d).alias("week"),
        iso_weekday(d).alias("day_of_week"),
        _label(DAY_NAMES, iso_weekday(d)).alias("day_name_ru"),
        iso_weekday(d).isin(6, 7).alias("is_weekend"),
        season(d).alias("season"),
        season_label(d).alias("season_label"),
        _label(AGRO_PHASES, F.month(d)).alias("agro_phase"),
    ]
