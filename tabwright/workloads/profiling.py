"""Profiles and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators.counts import distinct_counts, distinct_values
from tabwright.operators.profile import (
    ProfileSpec,
    category_profile,
    choose_columns,
    column_overview,
    correlations,
    describe_numbers,
    head_rows,
    histogram,
    median_table,
    missing_profile,
    profile_tables,
    table_shape,
)
from tabwright.operators.schema import roles_table
from tabwright.session import small_table
from tabwright.workloads.registry import GAPS_CTE, query, sales_with_gaps, table

NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def top_sql(source, columns, limit, prefix="WITH "):
    """Top values per column with ties to the smaller value and a rest row."""
    longs = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM {source}" for c in columns
    )
    return f"""{prefix}counted AS (SELECT col, value, count(*) AS n FROM ({longs}) GROUP BY col, value),
    placed AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, value NULLS LAST) AS place FROM counted),
    shown AS (SELECT col, place AS position, value, n, false AS is_other FROM placed WHERE place <= {limit}
      UNION ALL SELECT col, {limit + 1}, 'Other', sum(n), true FROM placed WHERE place > {limit} GROUP BY col)
    SELECT col AS "column", CAST(position AS BIGINT) AS position, value,
      CASE WHEN length(coalesce(value, 'Missing')) > 28 THEN substr(value, 1, 27) || '…'
        ELSE coalesce(value, 'Missing') END AS label, CAST(n AS BIGINT) AS n, is_other FROM shown"""


@query("category_top_n", top_sql("gaps", ("c_mktsegment", "n_name"), 4, GAPS_CTE + ", "))
def category_top_n(spark, sf_dir):
    return category_profile(sales_with_gaps(spark, sf_dir), ["c_mktsegment", "n_name"], 4)


@query("category_top_n_text", top_sql("documents", ("lang", "source", "text"), 12))
def category_top_n_text(spark, sf_dir):
    return category_profile(table(spark, sf_dir, "documents"), ["lang", "source", "text"], 12)


@query("category_top_n_events", top_sql("events", ("event_type", "user_id", "props"), 12))
def category_top_n_events(spark, sf_dir):
    return category_profile(table(spark, sf_dir, "events"), ["event_type", "user_id", "props"], 12)


@query("target_distribution", top_sql("orders", ("o_orderpriority",), 3))
def target_distribution(spark, sf_dir):
    return category_profile(table(spark, sf_dir, "orders"), ["o_orderpriority"], 3)


GAP_COLUMNS = ("o_orderkey", "o_orderpriority", "o_totalprice", "c_acctbal", "c_mktsegment", "n_name")


@query(
    "missing_profile",
    GAPS_CTE
    + " SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS missing,
        round((count(*) - count({c})) * 100.0 / count(*), 6) AS percent FROM gaps"""
        for c in GAP_COLUMNS
    )
    + ") WHERE missing > 0",
)
def missing_profile_query(spark, sf_dir):
    return missing_profile(sales_with_gaps(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


def histogram_sql(source, columns, bins, key=""):
    """Edges as low + i * step; a value's bin is the last edge it reaches."""
    parts = []
    for c in columns:
        parts.append(
            f"""SELECT '{c}' AS "column", CAST(bin AS BIGINT) AS bin, round(low + bin * step, 6) AS low,
            round(CASE WHEN bin = {bins - 1} THEN high ELSE low + (bin + 1) * step END, 6) AS high,
            CAST((SELECT count(*) FROM {source} WHERE {c} >= low + bin * step
              AND (bin = {bins - 1} OR {c} < low + (bin + 1) * step)) AS BIGINT) AS n
            FROM (SELECT low, high, (high - low) / {bins} AS step FROM (
              SELECT CASE WHEN min({c}) = max({c}) THEN min({c}) - 0.5 ELSE min({c}) END AS low,
                     CASE WHEN min({c}) = max({c}) THEN max({c}) + 0.5 ELSE max({c}) END AS high FROM {source})),
            range({bins}) AS r(bin)"""
        )
    return " UNION ALL ".join(parts)


@query("histogram", histogram_sql("lineitem", NUMBERS, 30))
def histogram_query(spark, sf_dir):
    df = histogram(table(spark, sf_dir, "lineitem"), NUMBERS, 30)
    return df.withColumns({c: F.round(c, 6) for c in ("low", "high")})


@query(
    "histogram_constant",
    histogram_sql("(SELECT c_acctbal, 7.0::DOUBLE AS fixed FROM customer)", ("c_acctbal", "fixed"), 10),
)
def histogram_constant(spark, sf_dir):
    df = table(spark, sf_dir, "customer").withColumn("fixed", F.lit(7.0))
    return histogram(df, ["c_acctbal", "fixed"], 10).withColumns(
        {c: F.round(c, 6) for c in ("low", "high")}
    )


@query(
    "median_table",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(median({c}), 6) AS median FROM lineitem""" for c in NUMBERS
    ),
)
def median_table_query(spark, sf_dir):
    return median_table(table(spark, sf_dir, "lineitem"), NUMBERS).withColumn(
        "median", F.round("median", 6)
    )


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS n, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
        round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75,
        max({c}) AS max FROM lineitem"""
        for c in NUMBERS
    ),
)
def describe_numeric(spark, sf_dir):
    df = describe_numbers(table(spark, sf_dir, "lineitem"), NUMBERS)
    return df.withColumns(
        {
            **{c: F.round(c, 4) for c in ("mean", "std")},
            **{c: F.round(c, 6) for c in ("p25", "p50", "p75")},
        }
    )


CORRELATED = (*NUMBERS, "fixed")


@query(
    "correlation_matrix",
    "WITH item AS (SELECT *, 1.0::DOUBLE AS fixed FROM lineitem) "
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS "left", '{b}' AS "right",
        CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN round(corr({a}, {b}), 6) END AS correlation FROM item"""
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def correlation_matrix(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("fixed", F.lit(1.0))
    return correlations(df, CORRELATED).withColumn("correlation", F.round("correlation", 6))


CUSTOMER_KINDS = (
    ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
    ("c_acctbal", "double"), ("c_mktsegment", "string"),
)


@query(
    "column_profile",
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS position, '{c}' AS "column", '{k}' AS dtype,
        CAST(count(*) AS BIGINT) AS rows, CAST(count({c}) AS BIGINT) AS non_null,
        CAST(count(*) - count({c}) AS BIGINT) AS missing,
        round((count(*) - count({c})) * 100.0 / count(*), 6) AS percent FROM customer"""
        for i, (c, k) in enumerate(CUSTOMER_KINDS)
    ),
)
def column_profile(spark, sf_dir):
    return column_overview(table(spark, sf_dir, "customer")).withColumn(
        "percent", F.round("percent", 6)
    )


@query(
    "column_roles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{'target' if c == 'c_mktsegment' else 'categorical' if k == 'string' else 'numeric'}' AS training_role,
        '{'target' if c == 'c_mktsegment' else 'categorical' if k == 'string' else 'numeric'}' AS profile_role,
        CAST(count({c}) AS BIGINT) AS non_null FROM customer"""
        for c, k in CUSTOMER_KINDS
    ),
)
def column_roles(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    filled = column_overview(df).select("column", "non_null")
    roles = roles_table(df, "c_mktsegment").select("column", "training_role", "profile_role")
    return roles.join(filled, "column")


@query(
    "chosen_columns",
    """SELECT 'numeric' AS kind, c AS "column" FROM (VALUES ('p_partkey'), ('p_size'), ('p_retailprice')) AS t(c)
    UNION ALL SELECT 'categorical', 'p_name' FROM part HAVING NOT (count(DISTINCT p_name) > 60 AND count(DISTINCT p_name) > 0.5 * count(*))
    UNION ALL SELECT 'categorical', 'p_brand' FROM part HAVING NOT (count(DISTINCT p_brand) > 60 AND count(DISTINCT p_brand) > 0.5 * count(*))
    UNION ALL SELECT 'categorical', 'p_type' FROM part HAVING NOT (count(DISTINCT p_type) > 60 AND count(DISTINCT p_type) > 0.5 * count(*))""",
)
def chosen_columns(spark, sf_dir):
    numeric, categorical, _ = choose_columns(table(spark, sf_dir, "part"), ProfileSpec())
    rows = [("numeric", c) for c in numeric] + [("categorical", c) for c in categorical]
    return small_table(spark, rows, "kind string, column string")


@query(
    "chosen_columns_identifiers",
    """SELECT 'numeric' AS kind, c AS "column" FROM (VALUES ('c_custkey'), ('c_nationkey'), ('c_acctbal')) AS t(c)
    UNION ALL SELECT 'categorical', 'c_name' FROM customer HAVING NOT (count(DISTINCT c_name) > 60 AND count(DISTINCT c_name) > 0.5 * count(*))
    UNION ALL SELECT 'categorical', 'c_mktsegment' FROM customer HAVING NOT (count(DISTINCT c_mktsegment) > 60 AND count(DISTINCT c_mktsegment) > 0.5 * count(*))""",
)
def chosen_columns_identifiers(spark, sf_dir):
    numeric, categorical, _ = choose_columns(table(spark, sf_dir, "customer"), ProfileSpec())
    rows = [("numeric", c) for c in numeric] + [("categorical", c) for c in categorical]
    return small_table(spark, rows, "kind string, column string")


@query(
    "distinct_values",
    """SELECT DISTINCT 'c_mktsegment' AS "column", c_mktsegment AS value FROM customer
    UNION ALL SELECT DISTINCT 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer""",
)
def distinct_values_query(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


PART_COLUMNS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query(
    "distinct_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM part"""
        for c in PART_COLUMNS
    ),
)
def distinct_counts_query(spark, sf_dir):
    return distinct_counts(table(spark, sf_dir, "part"))


@query(
    "table_shape",
    "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem",
)
def table_shape_query(spark, sf_dir):
    return table_shape(table(spark, sf_dir, "lineitem"))


@query(
    "head_rows",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25",
)
def head_rows_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return head_rows(orders, ["o_totalprice", "o_orderkey"], 25)


@query(
    "profile_outputs",
    """SELECT 'overview' AS output, CAST(5 AS BIGINT) AS rows
    UNION ALL SELECT 'target', CAST(least(count(DISTINCT c_mktsegment), 13) AS BIGINT) FROM customer
    UNION ALL SELECT 'histogram', CAST(90 AS BIGINT) UNION ALL SELECT 'medians', CAST(3 AS BIGINT)
    UNION ALL SELECT 'correlation', CAST(9 AS BIGINT)""",
)
def profile_outputs(spark, sf_dir):
    """Which tables a profile has, and how many rows each."""
    tables, _ = profile_tables(
        table(spark, sf_dir, "customer"), ProfileSpec(target_column="c_mktsegment")
    )
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("output"), "rows")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
