"""Raw -> staging value normalisation (text, GUIDs, numbers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

from fieldbook.constants import NULL_TEXTS, ZERO_GUID


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c) -> Column:
    """NULL, empty string and the literal text ``null`` become NULL.

    Exact match only: a blank ``" "`` is kept as is.
    """
    s = _c(c).cast("string")
    return F.when(s.isNull() | s.isin(*NULL_TEXTS), F.lit(None).cast("string")).otherwise(s)


def norm_guid(c) -> Column:
    """``norm_text`` plus the all-zero GUID -> NULL, lower-cased.

    Applied once at the raw -> staging edge so that "no link" is always NULL
    (this also removes a single-value join key that would otherwise be hot).
    """
    s = F.lower(norm_text(c))
    return F.when(s == F.lit(ZERO_GUID), F.lit(None).cast("string")).otherwise(s)


def strict_decimal(c, precision: int = 18, scale: int = 3) -> Column:
    """Decimal parse that fails the job on unparseable text.

    Independent of ``spark.sql.ansi.enabled``: a non-NULL input whose
    ``try_cast`` is NULL raises.
    """
    s = norm_text(c)
    t = DecimalType(precision, scale)
    parsed = s.try_cast(t)
    return F.when(s.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("not a decimal: "), s)).cast(t)).otherwise(parsed)


def strict_int(c) -> Column:
    s = norm_text(c)
    parsed = s.try_cast(IntegerType())
    return F.when(s.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("not an integer: "), s)).cast("int")).otherwise(parsed)


def lenient_decimal(c, precision: int = 18, scale: int = 3) -> Column:
    """Float-style parse; anything unparseable (or NaN/inf) becomes NULL."""
    s = norm_text(c)
    return s.try_cast("double").try_cast(DecimalType(precision, scale))


def passthrough_decimal(c, precision: int = 12, scale: int = 4) -> Column:
    """Catalog numbers arrive typed; only NULL-ish text is cleared."""
    col = _c(c)
    return F.when(norm_text(col).isNull(), F.lit(None)).otherwise(col).try_cast(DecimalType(precision, scale))


def falsy_to_null(c) -> Column:
    """``x or None`` on text: empty string -> NULL."""
    return F.nullif(_c(c).cast("string"), F.lit(""))
