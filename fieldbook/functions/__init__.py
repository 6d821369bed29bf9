"""Column expressions.  All are built-in Spark expressions (codegen, no UDF)."""

from fieldbook.functions.normalize import (  # noqa: F401
    falsy_to_null, lenient_decimal, norm_guid, norm_text, passthrough_decimal,
    strict_decimal, strict_int,
)
from fieldbook.functions.field_number import (  # noqa: F401
    field_number_any, field_number_plain, field_number_prefixed,
)
