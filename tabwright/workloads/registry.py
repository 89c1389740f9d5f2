"""Query registry and inputs shared by Spark and the oracle."""

from __future__ import annotations

from tabwright.sources.tables import read_table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` and its oracle SQL."""

    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return register


def table(spark, sf_dir: str, name: str):
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_sql(spark, sf_dir: str, sql: str, *names):
    """Run portable SQL whose ``{table}`` marks are the named tables."""
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def for_oracle(sql: str) -> str:
    """The same SQL for the oracle, whose tables are views."""
    return sql.replace("{", "").replace("}", "")


# A dirty variant of the customer table: every customer twice, the second time
# padded or rewritten, with missing markers, unreadable numbers and dates, and
# some rows without any value. Text only, so both engines build the same bytes.
DIRTY_SQL = """
SELECT
  CASE WHEN copy_no = 1 AND c_custkey % 19 = 0 THEN NULL
       WHEN copy_no = 1 THEN '  ' || CAST(c_custkey AS STRING) || chr(9)
       ELSE CAST(c_custkey AS STRING) END AS customer_id,
  CASE WHEN copy_no = 1 AND c_custkey % 19 = 0 THEN ' N/A '
       WHEN c_custkey % 11 = 0 THEN ' null '
       WHEN c_custkey % 13 = 0 THEN ''
       WHEN copy_no = 1 THEN chr(9) || c_mktsegment || ' ' || chr(160)
       ELSE c_mktsegment END AS market_segment,
  CASE WHEN copy_no = 1 AND c_custkey % 19 = 0 THEN 'None'
       WHEN c_custkey % 29 = 0 THEN '1.5f'
       WHEN c_custkey % 23 = 0 THEN 'unknown'
       WHEN c_custkey % 17 = 0 THEN ' -12.50 '
       WHEN c_custkey % 31 = 0 THEN '12e3'
       WHEN c_custkey % 7 = 0 THEN '$' || CAST(c_custkey AS STRING) || ',234.50'
       WHEN c_custkey % 5 = 0 AND copy_no = 1 THEN '€' || CAST(c_acctbal AS STRING)
       ELSE CAST(c_acctbal AS STRING) END AS account_balance,
  CASE WHEN copy_no = 1 AND c_custkey % 19 = 0 THEN 'NaN'
       WHEN c_custkey % 37 = 0 THEN 'not a date'
       WHEN c_custkey % 41 = 0 THEN '2023-02-30'
       WHEN c_custkey % 43 = 0 THEN '31/12/2020'
       WHEN c_custkey % 3 = 0 THEN
         CAST(DATE '1995-01-01' + CAST(c_custkey % 3000 AS INT) AS STRING) || ' 10:30:00'
       ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 3000 AS INT) AS STRING) END AS signup_date
FROM (SELECT *, 0 AS copy_no FROM {customer}
      UNION ALL SELECT *, 1 AS copy_no FROM {customer}) AS twice
"""
MESSY_NAMES = ("Customer ID", " Market-Segment ", "Account Balance ($)", "Signup__Date")
DIRTY_COLUMNS = ("customer_id", "market_segment", "account_balance", "signup_date")


def dirty_customer(spark, sf_dir: str, messy: bool = False):
    df = shared_sql(spark, sf_dir, DIRTY_SQL, "customer")
    return df.toDF(*MESSY_NAMES) if messy else df


def strip_sql(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))"


def blank_sql(x: str) -> str:
    s = strip_sql(x)
    return f"CASE WHEN lower({s}) IN ('', 'n/a', 'null', 'none', 'nan') THEN NULL ELSE {s} END"


def number_sql(x: str) -> str:
    s = strip_sql(x)
    return (
        f"CASE WHEN regexp_matches({s}, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') "
        f"THEN TRY_CAST({s} AS DOUBLE) END"
    )


def money_sql(x: str) -> str:
    return number_sql(f"regexp_replace({x}, '[,$€£₹]', '', 'g')")


def date_sql(x: str) -> str:
    return f"try_strptime({x}, ['%Y-%m-%d', '%Y-%m-%d %H:%M:%S'])"


DIRTY_CTE = f"WITH dirty AS ({for_oracle(DIRTY_SQL)})"
TEXT_CTE = DIRTY_CTE + ", texted AS (SELECT {} FROM dirty)".format(
    ", ".join(f"{blank_sql(c)} AS {c}" for c in DIRTY_COLUMNS)
)
KEPT_CTE = TEXT_CTE + ", kept AS (SELECT * FROM texted WHERE NOT ({}))".format(
    " AND ".join(f"{c} IS NULL" for c in DIRTY_COLUMNS)
)
UNIQUE_CTE = KEPT_CTE + ", uniq AS (SELECT DISTINCT * FROM kept)"
CLEAN_CTE = UNIQUE_CTE + (
    ", cleaned AS (SELECT customer_id, market_segment, "
    f"{money_sql('account_balance')} AS account_balance, "
    f"strftime({date_sql('signup_date')}, '%Y-%m-%d %H:%M:%S') AS signup_date FROM uniq)"
)

# Orders with their customer and nation: the modelling table.
SALES_SQL = """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CAST(year(o_orderdate) AS BIGINT) AS order_year,
       c_acctbal, c_mktsegment, n_name, n_regionkey
FROM {orders} AS o
JOIN {customer} AS c ON o.o_custkey = c.c_custkey
JOIN {nation} AS n ON c.c_nationkey = n.n_nationkey
"""
SALES_CTE = f"WITH sales AS ({for_oracle(SALES_SQL)})"

# The same with gaps in a number and in a text column.
GAPS_SQL = """
SELECT o_orderkey, o_orderpriority,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       c_acctbal,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE n_name END AS n_name
FROM {orders} AS o
JOIN {customer} AS c ON o.o_custkey = c.c_custkey
JOIN {nation} AS n ON c.c_nationkey = n.n_nationkey
"""
GAPS_CTE = f"WITH gaps AS ({for_oracle(GAPS_SQL)})"


def sales(spark, sf_dir):
    return shared_sql(spark, sf_dir, SALES_SQL, "orders", "customer", "nation")


def sales_with_gaps(spark, sf_dir):
    return shared_sql(spark, sf_dir, GAPS_SQL, "orders", "customer", "nation")
