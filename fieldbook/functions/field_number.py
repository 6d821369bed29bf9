"""Field numbers encoded in free text (warehouse / department / party names).

``"318, КаГалаРС2ПУч.6 2025 г."`` -> ``"318"`` (plain form, text before the
first comma) and ``"Поле 318"`` -> ``"318"`` (prefixed form).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.constants import FIELD_PREFIX_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_number_plain(c) -> Column:
    """Text before the first comma, trimmed; empty -> NULL; no comma -> whole text."""
    part = F.split_part(_c(c), F.lit(","), F.lit(1))
    return F.nullif(F.trim(part), F.lit(""))


def field_number_prefixed(c) -> Column:
    """Only when the text starts with the field word and blanks: the rest, trimmed.

    ``(?iu)`` is required: Java's ``(?i)`` alone does not fold Cyrillic case.
    """
    col = _c(c)
    rest = F.trim(F.regexp_replace(col, FIELD_PREFIX_PATTERN, ""))
    return F.when(col.rlike(FIELD_PREFIX_PATTERN), F.nullif(rest, F.lit("")))


def field_number_any(c) -> Column:
    """Prefixed form first, plain form otherwise."""
    return F.coalesce(field_number_prefixed(c), field_number_plain(c))
