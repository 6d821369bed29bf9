"""Parsers for names that encode field, crop, plot and year.

Party / department name:
    ``{field}, {crop+sort}{reproduction}{method}Уч.{plot}[_{field}] {year} г. [(не исп. с {dd.mm.yyyy})]``
    or a non-crop state ``{field}, {state} {year} г.`` (fallow, overgrown ...).
Harvest item name:
    ``Урожай {year} {sort}{reproduction} [{colour}] {с поливом|без полива}., поле {field}, уч.{plot}``

Everything is ``regexp_extract``; an absent group gives NULL, never an error.
The crop itself is resolved by joining the extracted code with a code map
(data, not code).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions.field_number import field_number_plain

# --- fixed values: grammar of the encoded names ---------------------------
PARTY_YEAR = r"(\d{4}) г\."
PARTY_PLOT = r"Уч\.(\d+)"
PARTY_REPRODUCTION = r"(РС\d+|ЭС|СЭ|ОС)"
PARTY_CODE = r"^[^,]*,\s*(.+?)(РС\d+|ЭС|СЭ|ОС)"
PARTY_METHOD = r"(?:РС\d+|ЭС|СЭ|ОС)(.*?)Уч\."
PARTY_STATE = r"^[^,]*,\s*(\S+) \d{4} г\."
PARTY_UNUSED_SINCE = r"не исп\. с (\d{2}\.\d{2}\.\d{4})"
ITEM_YEAR = r"(?iu)урожай\s+(\d{4})"
ITEM_SORT = r"(?iu)урожай\s+\d{4}\s+(\S+?)(?:РС\d+|ЭС|СЭ|ОС|\s)"
ITEM_REPRODUCTION = r"(?u)\d{4}\s+\S*?(РС\d+|ЭС|СЭ|ОС)"
ITEM_IRRIGATED = r"(?iu)с поливом"
ITEM_NOT_IRRIGATED = r"(?iu)без полива"
ITEM_FIELD = r"(?iu)поле\s+(\d+)"
ITEM_PLOT = r"(?iu)уч\.\s*(\d+)"
IRRIGATED_LABEL = "С поливом"
NOT_IRRIGATED_LABEL = "Без полива"
ARTICLE_CALIBER = r"(\d+(?:-\d+)?\+?)"
ARTICLE_PARTS = r"^([^_]*)_([^_/]*)/?([^_]*)_?(.*)$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract(c: Column, pattern: str, idx: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, idx), F.lit(""))


def parse_party_name(c) -> Column:
    """Struct of the party-name parts: field, crop_code, reproduction, method, plot,
    year, state (non-crop), unused_since."""
    t = _c(c)
    crop_year = _extract(t, PARTY_YEAR).cast("int")
    has_plot = t.rlike(PARTY_PLOT)
    return F.struct(
        field_number_plain(t).alias("field"),
        F.when(has_plot, _extract(t, PARTY_CODE, 1)).alias("crop_code"),
        F.when(has_plot, _extract(t, PARTY_REPRODUCTION)).alias("reproduction"),
        F.when(has_plot, F.nullif(F.trim(F.regexp_extract(t, PARTY_METHOD, 1)), F.lit(""))).alias("method"),
        _extract(t, PARTY_PLOT).cast("int").alias("plot"),
        crop_year.alias("year"),
        F.when(~has_plot, _extract(t, PARTY_STATE)).alias("state"),
        F.to_date(_extract(t, PARTY_UNUSED_SINCE), "dd.MM.yyyy").alias("unused_since"),
    )


def parse_item_name(c) -> Column:
    """Struct of the harvest item-name parts: year, sort, reproduction,
    irrigation, field, plot."""
    t = _c(c)
    irrigation = (F.when(t.rlike(ITEM_IRRIGATED), F.lit(IRRIGATED_LABEL))
                  .when(t.rlike(ITEM_NOT_IRRIGATED), F.lit(NOT_IRRIGATED_LABEL)))
    return F.struct(
        _extract(t, ITEM_YEAR).cast("int").alias("year"),
        _extract(t, ITEM_SORT).alias("sort"),
        _extract(t, ITEM_REPRODUCTION).alias("reproduction"),
        irrigation.alias("irrigation"),
        _extract(t, ITEM_FIELD).alias("field"),
        _extract(t, ITEM_PLOT).cast("int").alias("plot"),
    )


def parse_article(c) -> Column:
    """Item article ``{kind}_{code}{caliber}/{...}_{label}``: only the visible
    parts of the single known sample are extracted (caliber and tail label)."""
    t = _c(c)
    return F.struct(
        _extract(t, ARTICLE_PARTS, 1).alias("kind"),
        _extract(_extract(t, ARTICLE_PARTS, 2), ARTICLE_CALIBER).alias("caliber"),
        _extract(t, ARTICLE_PARTS, 4).alias("label"),
    )
