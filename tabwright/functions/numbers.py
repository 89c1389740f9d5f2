"""Number expressions: strict text parsing and NaN handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.text import strip_text

# --- fixed values -----------------------------------------------------------
# Number texts; Spark's own cast would also take Java forms such as 1.5f or 2d.
NUMBER_PATTERN = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"
CURRENCY_MARKS = "[,$€£₹]"
# ----------------------------------------------------------------------------


def nan_to_null(c: Column, dtype: T.DataType) -> Column:
    """Missing is NULL only: turn float NaN into NULL."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    return c


def drop_currency_marks(c: Column) -> Column:
    """Remove thousands separators and currency signs, then strip."""
    return strip_text(F.regexp_replace(c, CURRENCY_MARKS, ""))


def to_number(c: Column, dtype: T.DataType) -> Column:
    """``c`` as a number; anything that is not one becomes NULL.

    Integral columns stay integral, booleans become 0/1, text is parsed as a
    plain decimal, exponent or infinity form.
    """
    if isinstance(dtype, T.IntegralType):
        return c
    if isinstance(dtype, T.StringType):
        text = strip_text(c)
        return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    if isinstance(dtype, T.NumericType):
        return nan_to_null(c, dtype).cast("double")
    return F.lit(None).cast("double")


def is_infinite(c: Column) -> Column:
    """True for +inf and -inf; false for NULL."""
    return F.coalesce(F.abs(c) == F.lit(float("inf")), F.lit(False))
