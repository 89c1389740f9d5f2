"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.text import strip_text

# Formats are tried in order for every value, so the result does not depend on
# which row comes first.
DEFAULT_DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
)


def parse_timestamp(c: Column, dtype: T.DataType, formats=DEFAULT_DATE_FORMATS) -> Column:
    """``c`` as a timestamp; unparseable values become NULL.

    Whole numbers are nanoseconds since the epoch.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp")
    if isinstance(dtype, T.IntegralType):
        return F.timestamp_micros(F.floor(c / F.lit(1000)).cast("bigint"))
    if isinstance(dtype, T.StringType):
        text = strip_text(c)
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])
    return F.lit(None).cast("timestamp")


def date_parts(name: str, ts: Column) -> dict:
    """Year, month, quarter and day of week (Monday = 0) of ``ts``."""
    return {
        f"{name}_year": F.year(ts),
        f"{name}_month": F.month(ts),
        f"{name}_quarter": F.quarter(ts),
        f"{name}_day_of_week": F.weekday(ts),
    }
