"""Label derivations used by the star schema and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.constants import (
    COLOR_RED, COLOR_RED_PATTERN, COLOR_WHITE, COLOR_WHITE_PATTERN,
    IRRIGATION_UNKNOWN, SORT_UNKNOWN, UNRESOLVED_ITEM_PREFIX,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def color_label(item_name, party_name) -> Column:
    """First match wins: white, then red, else NULL (case-insensitive, Cyrillic)."""
    a, b = _c(item_name), _c(party_name)
    white = a.ilike(COLOR_WHITE_PATTERN) | b.ilike(COLOR_WHITE_PATTERN)
    red = a.ilike(COLOR_RED_PATTERN) | b.ilike(COLOR_RED_PATTERN)
    return F.when(white, F.lit(COLOR_WHITE)).when(red, F.lit(COLOR_RED))


def variety_label(crop, sort) -> Column:
    """``crop / sort``; NULL crop is skipped, missing sort gets the default text."""
    return F.concat_ws(" / ", _c(crop), F.coalesce(_c(sort), F.lit(SORT_UNKNOWN)))


def sentinel_null(c, sentinel: str) -> Column:
    return F.nullif(_c(c), F.lit(sentinel))


def reproduction_label(c) -> Column:
    return sentinel_null(c, "")


def irrigation_label(c) -> Column:
    return sentinel_null(c, IRRIGATION_UNKNOWN)


def label_chain(*cols, default: str | None = None) -> Column:
    """First non-empty of the columns, else the default text."""
    parts = [F.nullif(_c(c).cast("string"), F.lit("")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def unresolved_item_label(name, item_id) -> Column:
    return F.coalesce(_c(name), F.concat(F.lit(UNRESOLVED_ITEM_PREFIX), _c(item_id).cast("string")))
