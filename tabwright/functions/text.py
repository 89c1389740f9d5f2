"""Text expressions and name rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Texts a CSV reader takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Texts the cleaning step takes as missing, compared without case.
MISSING_MARKERS = ("", "n/a", "null", "none", "nan")
# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# A cell a spreadsheet would run as a formula.
FORMULA_PATTERN = r"^[ \t\r\n]*[=+\-@]|^[\t\r\n]"
# ----------------------------------------------------------------------------


def strip_text(c: Column) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` alone removes only 0x20)."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column, markers=MISSING_MARKERS) -> Column:
    """Stripped text; NULL where it equals one of ``markers`` ignoring case."""
    wanted = sorted({m.strip().casefold() for m in markers})
    stripped = strip_text(c)
    if not wanted:
        return stripped
    return F.when(~F.lower(stripped).isin(wanted), stripped)


def formula_safe(c: Column) -> Column:
    """Put ``'`` before text that a spreadsheet would evaluate."""
    return F.when(c.rlike(FORMULA_PATTERN), F.concat(F.lit("'"), c)).otherwise(c)


def shorten_label(c: Column, width: int = 28) -> Column:
    """``Missing`` for NULL; texts over ``width`` end in an ellipsis."""
    text = F.coalesce(c.cast("string"), F.lit("Missing"))
    return F.when(
        F.length(text) > width, F.concat(F.substring(text, 1, width - 1), F.lit("…"))
    ).otherwise(text)


def normalize_column_name(name) -> str:
    """snake_case name: lower case, other characters collapse to ``_``."""
    return re.sub("[^a-z0-9]+", "_", str(name).strip().lower()).strip("_")


def safe_label(value) -> str:
    """Class label as a column-name suffix; ``unknown`` when nothing is left."""
    return normalize_column_name(value) or "unknown"


def display_name(column) -> str:
    """Readable title of a snake_case column name."""
    return " ".join(part for part in str(column).split("_") if part).strip().title()
