"""Column expressions: text, numbers, dates. All JVM-side built-ins."""

from tabwright.functions.dates import DEFAULT_DATE_FORMATS, date_parts, parse_timestamp
from tabwright.functions.numbers import (
    drop_currency_marks,
    is_infinite,
    nan_to_null,
    to_number,
)
from tabwright.functions.text import (
    MISSING_MARKERS,
    NA_TOKENS,
    blank_to_null,
    display_name,
    formula_safe,
    normalize_column_name,
    safe_label,
    shorten_label,
    strip_text,
)

__all__ = [
    "DEFAULT_DATE_FORMATS",
    "MISSING_MARKERS",
    "NA_TOKENS",
    "blank_to_null",
    "date_parts",
    "display_name",
    "drop_currency_marks",
    "formula_safe",
    "is_infinite",
    "nan_to_null",
    "normalize_column_name",
    "parse_timestamp",
    "safe_label",
    "shorten_label",
    "strip_text",
    "to_number",
]
