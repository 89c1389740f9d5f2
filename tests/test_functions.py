from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import (
    blank_to_null,
    display_name,
    drop_currency_marks,
    formula_safe,
    normalize_column_name,
    parse_timestamp,
    safe_label,
    shorten_label,
    strip_text,
    to_number,
)


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i bigint, c {kind}")
    rows = df.select("i", expression(F.col("c")).alias("out")).sort("i").collect()
    return [r["out"] for r in rows]


def test_names():
    assert normalize_column_name("  AI Adoption-Level (%) ") == "ai_adoption_level"
    assert normalize_column_name("%%") == ""
    assert safe_label("Acquired (Fire Sale)") == "acquired_fire_sale"
    assert safe_label(" ?? ") == "unknown"
    assert display_name("total__funding_usd") == "Total Funding Usd"


def test_strip_matches_python(spark):
    values = [" a\t", "  b c 　", "\x1cx\x1f", "", " \n", "plain", None]
    got = column(spark, values, strip_text)
    assert got == [v if v is None else v.strip() for v in values]


def test_missing_markers(spark):
    values = [" N/A ", "NULL", "none", "nan", "", "Nancy", " Other "]
    assert column(spark, values, blank_to_null) == [None] * 5 + ["Nancy", "Other"]
    assert column(spark, ["-", "x"], lambda c: blank_to_null(c, (" - ",))) == [None, "x"]


def test_strict_numbers(spark):
    values = ["1", " 2.5 ", ".5", "3.", "1e3", "-4E-2", "1.5f", "2d", "0x1p3", "1_0", "nan", "",
              "inf", "-Infinity", "1e400", "abc", None]
    got = column(spark, values, lambda c: to_number(c, T.StringType()))
    inf = float("inf")
    assert got == [1.0, 2.5, 0.5, 3.0, 1000.0, -0.04, None, None, None, None, None, None,
                   inf, -inf, inf, None, None]


def test_numbers_of_other_types(spark):
    nan = float("nan")
    assert column(spark, [1.0, nan, None], lambda c: to_number(c, T.DoubleType()), "double") == [1.0, None, None]
    assert column(spark, [True, False, None], lambda c: to_number(c, T.BooleanType()), "boolean") == [1, 0, None]


def test_currency(spark):
    assert column(spark, ["$1,000", "€ 2.5", "₹3", "£-4 "], drop_currency_marks) == ["1000", "2.5", "3", "-4"]


def test_dates(spark):
    values = ["2024-02-29", " 2024-02-29 10:30:00 ", "2024-02-29T10:30:00", "2023-02-30", "x", None]
    got = column(spark, values, lambda c: F.date_format(parse_timestamp(c, T.StringType()), "yyyy-MM-dd HH:mm"))
    assert got == ["2024-02-29 00:00", "2024-02-29 10:30", "2024-02-29 10:30", None, None, None]
    nanos = column(spark, [1_700_000_000_000_000_000], lambda c: F.year(parse_timestamp(c, T.LongType())), "bigint")
    assert nanos == [2023]


def test_formula_guard(spark):
    guarded = ["=1+1", "  +x", "-3", "@x", "\tx", "\rx", "\nx"]
    plain = ["a=b", " x", "", None]
    got = column(spark, guarded + plain, formula_safe)
    assert got == ["'" + t for t in guarded] + plain


def test_labels(spark):
    long = "x" * 29
    assert column(spark, [None, "ok", "y" * 28, long], shorten_label) == ["Missing", "ok", "y" * 28, "x" * 27 + "…"]
