"""Sources, validation and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.errors import ValidationFailure
from tabwright.operators.clean import (
    CleaningSpec,
    clean_table,
    clean_text,
    complete_rows,
    convert_dates,
    convert_numbers,
    drop_empty,
    drop_repeats,
    incomplete_rows,
    invalid_counts,
    row_accounting,
    trimmed_rows,
)
from tabwright.operators.counts import missing_counts, missing_summary
from tabwright.operators.duplicates import duplicate_count, repeated_rows
from tabwright.operators.schema import normalize_columns
from tabwright.operators.validate import (
    ValidationRules,
    missing_over,
    unexpected_labels,
    validate_table,
    validation_findings,
)
from tabwright.plans.prepare import prepare_path
from tabwright.session import scratch_path, small_table
from tabwright.sources.strict import (
    StrictSpec,
    as_scoring_input,
    read_strict_csv,
    violation_counts,
    violations,
    with_generated_key,
)
from tabwright.sources.tables import csv_ragged_counts, raw_csv, export_csv, read_table, write_table
from tabwright.sources.rawbytes import WHOLE_BYTES, copy_bytes
from tabwright.sources.zones import ingest, ingest_bytes, same_bytes
from tabwright.workloads.registry import (
    CLEAN_CTE,
    DIRTY_COLUMNS,
    DIRTY_CTE,
    KEPT_CTE,
    TEXT_CTE,
    UNIQUE_CTE,

    date_sql,
    dirty_customer,
    for_oracle,
    money_sql,
    number_sql,
    query,
    shared_sql,
    strip_sql,
    table,
)

SPEC = CleaningSpec(numeric_columns=("account_balance",), date_columns=("signup_date",))
STAMP = "yyyy-MM-dd HH:mm:ss"
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def stamped(df):
    return df.withColumn("signup_date", F.date_format("signup_date", STAMP))


@query("ingest_snapshot", CUSTOMER_SQL)
def ingest_snapshot(spark, sf_dir):
    raw = scratch_path(spark, "raw")
    return ingest(spark, f"{sf_dir.rstrip('/')}/customer.parquet", raw)[1]


# Lines with two cells, a repeated header or a surplus cell, ended by carriage return and feed.
RAW_LINES = """CASE WHEN c_custkey % 50 = 7 THEN 'key,name' WHEN c_custkey % 10 = 3 THEN c_custkey || ',' || c_name || ',more'
  ELSE c_custkey || ',"' || c_name || '"' END"""


@query(
    "ingest_bytes",
    f"""WITH files AS (SELECT 'file=' || (c_custkey % 3) AS file,
      'key,name' || chr(13) || chr(10) || string_agg({RAW_LINES} || chr(13) || chr(10), '' ORDER BY c_custkey) AS body
    FROM customer GROUP BY c_custkey % 3)
  SELECT way, file, CAST(strlen(body) AS BIGINT) AS bytes, sha256(body) AS sha256, true AS same
  FROM files, (VALUES ('rows'), ('ranges')) AS ways(way)""",
)
def ingest_bytes_query(spark, sf_dir):
    """Three CSV files copied into the raw zone, as whole rows and as ranges of lines."""
    base = scratch_path(spark, "landing")
    heads = spark.range(-3, 0).select(F.col("id").alias("c_custkey"), F.lit("key,name").alias("value"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.expr(RAW_LINES).alias("value"))
    lines = customers.unionByName(heads).withColumn("file", F.pmod("c_custkey", F.lit(3)))
    ordered = lines.repartition(3, "file").sortWithinPartitions("file", "c_custkey")
    ordered.select("value", "file").write.partitionBy("file").option("lineSep", "\r\n").text(base)
    found = []
    for way, whole_bytes in (("rows", WHOLE_BYTES), ("ranges", 0)):
        copy = copy_bytes(spark, base, scratch_path(spark, way), whole_bytes=whole_bytes)
        seen = same_bytes(spark, base, copy, whole_bytes=whole_bytes)
        folder = F.substring_index("file", "/", 1).alias("file")
        found.append(seen.select(F.lit(way).alias("way"), folder, "bytes", "sha256", "same"))
    return found[0].unionByName(found[1])


@query("ingest_bytes_read", CUSTOMER_SQL.replace("c_nationkey", "CAST(c_nationkey AS BIGINT) AS c_nationkey"))
def ingest_bytes_read(spark, sf_dir):
    """A CSV copied byte for byte as ranges of lines, then read from its parts."""
    base = scratch_path(spark, "customers.csv")
    write_table(table(spark, sf_dir, "customer"), base)
    return ingest_bytes(spark, base, scratch_path(spark, "raw"), whole_bytes=0)[1]


@query("normalized_names", DIRTY_CTE + " SELECT * FROM dirty")
def normalized_names(spark, sf_dir):
    return normalize_columns(dirty_customer(spark, sf_dir, messy=True))[0]


NA_SQL = "CASE WHEN {0} IN ('', 'N/A', 'NULL', 'NaN', 'None', 'null', 'nan', 'n/a', 'NA') THEN NULL ELSE {0} END"


@query(
    "csv_na_tokens",
    DIRTY_CTE
    + f" SELECT CAST({strip_sql('customer_id')} AS BIGINT) AS customer_id, "
    + ", ".join(f"{NA_SQL.format(c)} AS {c}" for c in DIRTY_COLUMNS[1:])
    + " FROM dirty",
)
def csv_na_tokens(spark, sf_dir):
    path = scratch_path(spark, "dirty.csv")
    write_table(dirty_customer(spark, sf_dir), path)
    return read_table(spark, path)


@query("csv_text_roundtrip", "SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents")
def csv_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "documents.csv")
    documents = table(spark, sf_dir, "documents")
    write_table(documents, path)
    return read_table(spark, path, documents.schema, multiline=True)


RAGGED = """CASE o_orderkey % 10 WHEN 3 THEN o_orderkey || ',' || o_orderpriority || ',' || o_orderstatus
  WHEN 4 THEN o_orderkey || '' ELSE o_orderkey || ',"' || o_orderpriority || '"' END"""


def _ragged_csv(spark, sf_dir):
    """Orders as CSV lines of two cells; some lines have one or three."""
    path = scratch_path(spark, "ragged.csv")
    lines = table(spark, sf_dir, "orders").select(F.expr(RAGGED).alias("key,priority"))
    lines.write.csv(path, header=True, sep="\u0001", quote="\u0000", escapeQuotes=False)
    return path


@query(
    "csv_ragged_counts",
    """SELECT CAST(count(*) AS BIGINT) AS records, CAST(count(*) FILTER (o_orderkey % 10 = 4) AS BIGINT) AS short_records,
    CAST(count(*) FILTER (o_orderkey % 10 = 3) AS BIGINT) AS long_records FROM orders""",
)
def ragged_counts(spark, sf_dir):
    return csv_ragged_counts(spark, _ragged_csv(spark, sf_dir))


@query(
    "csv_ragged_dropped",
    """SELECT CAST(o_orderkey AS BIGINT) AS key, CASE WHEN o_orderkey % 10 <> 4 THEN o_orderpriority END AS priority
    FROM orders WHERE o_orderkey % 10 <> 3""",
)
def csv_ragged_dropped(spark, sf_dir):
    text = raw_csv(spark, _ragged_csv(spark, sf_dir), ragged="drop")
    return text.select(F.col("key").cast("bigint").alias("key"), "priority")


@query("json_document", "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name FROM supplier")
def json_document(spark, sf_dir):
    """One JSON array over many lines, read as records."""
    path = scratch_path(spark, "suppliers.json")
    records = table(spark, sf_dir, "supplier").select(F.to_json(F.struct("s_suppkey", "s_name")).alias("r"))
    whole = records.agg(F.concat(F.lit("[\n  "), F.array_join(F.collect_list("r"), ",\n  "), F.lit("\n]\n")))
    whole.write.text(path)
    return read_table(spark, path).select("s_suppkey", "s_name")


@query(
    "json_parquet_roundtrip",
    CUSTOMER_SQL.replace("c_nationkey", "CAST(c_nationkey AS BIGINT) AS c_nationkey"),
)
def json_parquet_roundtrip(spark, sf_dir):
    as_json, as_parquet = scratch_path(spark, "customer.json"), scratch_path(spark, "customer.parquet")
    write_table(table(spark, sf_dir, "customer"), as_json)
    write_table(read_table(spark, as_json), as_parquet)
    return read_table(spark, as_parquet)


FORMULA_SQL = """
SELECT c_custkey,
  CASE c_custkey % 8 WHEN 0 THEN '=' || c_name WHEN 1 THEN '  +' || c_name
    WHEN 2 THEN '-' || c_name WHEN 3 THEN ' ' || chr(10) || '@' || c_name
    WHEN 4 THEN chr(9) || c_name WHEN 5 THEN ' ' || c_name WHEN 6 THEN '' || c_name || '='
    ELSE c_name END AS c_name,
  c_mktsegment
FROM {customer}
"""


@query(
    "formula_safe_export",
    rf"""SELECT c_custkey, CASE WHEN regexp_matches(c_name, '^[ \t\r\n]*[=+\-@]|^[\t\r\n]')
    THEN '''' || c_name ELSE c_name END AS c_name, c_mktsegment FROM ({for_oracle(FORMULA_SQL)})""",
)
def formula_safe_export(spark, sf_dir):
    path = scratch_path(spark, "export.csv")
    export_csv(shared_sql(spark, sf_dir, FORMULA_SQL, "customer"), path)
    return read_table(spark, path, multiline=True)


STRICT_SQL = """
SELECT c_custkey,
  CASE WHEN c_custkey % 47 = 0 THEN 'many' WHEN c_custkey % 53 = 0 THEN '-Infinity'
    WHEN c_custkey % 59 = 0 THEN NULL ELSE CAST(c_acctbal AS STRING) END AS balance,
  CASE WHEN c_custkey % 61 = 0 THEN '7d' WHEN c_custkey % 67 = 0 THEN 'inf'
    ELSE CAST(c_nationkey AS STRING) END AS nation,
  ' ' || c_mktsegment || chr(9) AS segment
FROM {customer}
"""
STRICT = StrictSpec(
    required_columns=("balance", "nation", "segment"),
    numeric_columns=("balance", "nation"),
    text_columns=("segment",),
    nonnegative_columns=("balance", "nation"),
)


def _strict_long(extra=""):
    parts = []
    for c in ("balance", "nation"):
        number = (
            f"CASE WHEN lower({c}) = 'inf' OR lower({c}) = 'infinity' THEN CAST('inf' AS DOUBLE) "
            f"WHEN lower({c}) = '-infinity' THEN CAST('-inf' AS DOUBLE) ELSE {number_sql(c)} END"
        )
        for rule, test in (
            ("not_a_number", f"{c} IS NOT NULL AND ({number}) IS NULL"),
            ("infinite", f"isinf({number})"),
            ("negative", f"({number}) < 0"),
        ):
            parts.append(
                f"SELECT '{rule}' AS rule, '{c}' AS col, c_custkey, {c} AS value FROM strict WHERE {test}"
            )
    return f"WITH strict AS ({for_oracle(STRICT_SQL)}), found AS ({' UNION ALL '.join(parts)})"


@query(
    "strict_source_violations",
    _strict_long()
    + """ SELECT rule, col AS "column", CAST(c_custkey AS VARCHAR) AS row_key, value FROM (
      SELECT *, row_number() OVER (PARTITION BY rule, col ORDER BY c_custkey) AS place FROM found)
      WHERE place <= 5""",
)
def strict_source_violations(spark, sf_dir):
    return violations(shared_sql(spark, sf_dir, STRICT_SQL, "customer"), STRICT, "c_custkey")


@query(
    "strict_violation_counts",
    _strict_long() + ' SELECT rule, col AS "column", CAST(count(*) AS BIGINT) AS rows FROM found GROUP BY rule, col',
)
def strict_violation_counts(spark, sf_dir):
    return violation_counts(shared_sql(spark, sf_dir, STRICT_SQL, "customer"), STRICT, "c_custkey")


@query(
    "strict_source_typed",
    f"""SELECT c_custkey, trim(segment, ' ' || chr(9)) AS segment, {number_sql('nation')} AS nation
    FROM (SELECT c_custkey, segment, CASE WHEN lower(nation) = 'inf' THEN NULL ELSE nation END AS nation
          FROM ({for_oracle(STRICT_SQL)}))""",
)
def strict_source_typed(spark, sf_dir):
    df = as_scoring_input(shared_sql(spark, sf_dir, STRICT_SQL, "customer"), STRICT)
    finite = F.when(F.abs("nation") < float("inf"), F.col("nation"))
    return df.select("c_custkey", "segment", finite.alias("nation"))


UPLOAD_SQL = """SELECT c_name AS "Customer Name", abs(c_acctbal) AS "Balance ($)", ' ' || c_mktsegment || ' ' AS segment,
  c_nationkey AS nation, c_custkey % 2 AS churned FROM {customer} ORDER BY c_custkey"""


@query(
    "strict_reader",
    """SELECT 'UPLOAD-' || CASE WHEN n < 100000 THEN lpad(CAST(n AS VARCHAR), 5, '0') ELSE CAST(n AS VARCHAR) END AS key,
    customer_name, balance, segment, nation
  FROM (SELECT row_number() OVER (ORDER BY c_custkey) AS n, c_name AS customer_name, abs(c_acctbal) AS balance,
    c_mktsegment AS segment, CAST(c_nationkey AS DOUBLE) AS nation FROM customer)""",
)
def strict_reader(spark, sf_dir):
    """An upload read strictly: names normalised, target left out, keys numbered in file order."""
    path = scratch_path(spark, "upload.csv")
    text = UPLOAD_SQL.replace('"', "`")
    write_table(shared_sql(spark, sf_dir, text, "customer"), path)
    spec = StrictSpec(
        required_columns=("key", "balance", "nation", "segment"),
        numeric_columns=("balance", "nation"),
        text_columns=("segment",),
        nonnegative_columns=("balance", "nation"),
        target_column="churned",
        key_column="key",
    )
    frame, warnings = read_strict_csv(spark, path, spec)
    if len(warnings) != 3:
        raise ValueError(f"expected a dropped target, an extra column and keys: {warnings}")
    return frame


@query(
    "upload_key_generation",
    """SELECT c_custkey, c_mktsegment, 'UPLOAD-' || CASE WHEN n < 100000
      THEN lpad(CAST(n AS VARCHAR), 5, '0') ELSE CAST(n AS VARCHAR) END AS upload_id
    FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS n FROM customer)""",
)
def upload_key_generation(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return with_generated_key(rows, StrictSpec(key_column="upload_id"), ["c_custkey"])


def _texted(spark, sf_dir):
    return clean_text(dirty_customer(spark, sf_dir))


def _per_column(source, value):
    return " UNION ALL ".join(
        value.format(c=c, source=source) for c in DIRTY_COLUMNS
    )


MISSING_SQL = _per_column(
    "texted",
    "SELECT '{c}' AS \"column\", CAST(count(*) AS BIGINT) AS rows, "
    "CAST(count(*) - count({c}) AS BIGINT) AS missing, "
    "round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS fraction FROM {source}",
)


@query("missing_counts", TEXT_CTE + " " + MISSING_SQL)
def missing_counts_query(spark, sf_dir):
    return missing_counts(_texted(spark, sf_dir)).withColumn("fraction", F.round("fraction", 6))


@query(
    "missing_fraction_over",
    TEXT_CTE + f', per AS ({MISSING_SQL}) SELECT "column", round(fraction, 4) AS fraction FROM per WHERE fraction > 0.1',
)
def missing_fraction_over(spark, sf_dir):
    return missing_over(_texted(spark, sf_dir), 0.1)


@query(
    "missing_summary",
    TEXT_CTE
    + f""", per AS ({MISSING_SQL}) SELECT max(rows) AS rows, CAST(count(*) AS BIGINT) AS columns,
    CAST(sum(rows) AS BIGINT) AS cells, CAST(sum(missing) AS BIGINT) AS missing_cells,
    round(sum(missing) * 100.0 / sum(rows), 6) AS missing_percent FROM per""",
)
def missing_summary_query(spark, sf_dir):
    return missing_summary(_texted(spark, sf_dir)).withColumn(
        "missing_percent", F.round("missing_percent", 6)
    )


@query(
    "duplicate_rows",
    TEXT_CTE + " SELECT CAST((SELECT count(*) FROM texted) - (SELECT count(*) FROM (SELECT DISTINCT * FROM texted)) AS BIGINT) AS duplicate_rows",
)
def duplicate_rows(spark, sf_dir):
    return duplicate_count(_texted(spark, sf_dir))


@query(
    "duplicate_documents",
    "SELECT CAST(count(*) - count(DISTINCT (text, lang, source, n_chars)) AS BIGINT) AS duplicate_rows FROM documents",
)
def duplicate_documents(spark, sf_dir):
    return duplicate_count(table(spark, sf_dir, "documents").drop("doc_id"))


@query(
    "repeated_documents",
    """SELECT text, lang, source, n_chars, CAST(count(*) AS BIGINT) AS copies FROM documents
    GROUP BY text, lang, source, n_chars HAVING count(*) > 1""",
)
def repeated_documents(spark, sf_dir):
    return repeated_rows(table(spark, sf_dir, "documents").drop("doc_id"))


ALLOWED = ("1-URGENT", " 2-HIGH ", "3-MEDIUM")


@query(
    "unexpected_labels",
    """SELECT DISTINCT trim(o_orderpriority) AS value FROM orders
    WHERE trim(o_orderpriority) NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def unexpected_labels_query(spark, sf_dir):
    return unexpected_labels(table(spark, sf_dir, "orders"), "o_orderpriority", ALLOWED)


RULES = ValidationRules(
    required_columns=("customer_id", "loyalty_tier"),
    target_column="market_segment",
    allowed_target_values=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    max_missing_fraction=0.1,
    fail_on_duplicate_rows=True,
)


@query(
    "validation_report",
    TEXT_CTE
    + f""", per AS ({MISSING_SQL})
    SELECT 'error' AS severity, 'required_column' AS rule, 'loyalty_tier' AS "column", '' AS value
    UNION ALL SELECT 'error', 'no_rows', '', '' FROM (SELECT count(*) AS n FROM texted) WHERE n = 0
    UNION ALL SELECT 'error', 'missing_fraction', "column", CAST(round(fraction, 4) AS VARCHAR) FROM per WHERE fraction > 0.1
    UNION ALL SELECT 'error', 'duplicate_rows', '', CAST(n AS VARCHAR) FROM (
      SELECT (SELECT count(*) FROM texted) - (SELECT count(*) FROM (SELECT DISTINCT * FROM texted)) AS n) WHERE n > 0
    UNION ALL SELECT 'error', 'missing_target', "column", CAST(missing AS VARCHAR) FROM per
      WHERE "column" = 'market_segment' AND missing > 0
    UNION ALL SELECT DISTINCT 'error', 'unexpected_label', 'market_segment', market_segment FROM texted
      WHERE market_segment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
)
def validation_report(spark, sf_dir):
    return validation_findings(_texted(spark, sf_dir), RULES)


@query(
    "validation_summary",
    """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(6 AS BIGINT) AS columns,
    CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS BIGINT) AS duplicate_rows,
    CAST(count(*) - count(o_orderpriority) AS BIGINT) AS missing_target FROM orders""",
)
def validation_summary(spark, sf_dir):
    rules = ValidationRules(("o_orderkey",), "o_orderpriority", (*ALLOWED, "4-NOT SPECIFIED", "5-LOW"))
    report = validate_table(table(spark, sf_dir, "orders"), rules)
    row = (report.rows, report.columns, report.duplicate_rows, report.missing_values["o_orderpriority"])
    return small_table(
        spark, [row], "rows bigint, columns bigint, duplicate_rows bigint, missing_target bigint"
    )


@query("clean_text", TEXT_CTE + " SELECT * FROM texted")
def clean_text_query(spark, sf_dir):
    return _texted(spark, sf_dir)


@query("drop_empty", KEPT_CTE + " SELECT * FROM kept")
def drop_empty_query(spark, sf_dir):
    return drop_empty(_texted(spark, sf_dir))


@query("dedupe", UNIQUE_CTE + " SELECT * FROM uniq")
def dedupe(spark, sf_dir):
    return drop_repeats(drop_empty(_texted(spark, sf_dir)))


@query(
    "clean_numeric",
    DIRTY_CTE + f" SELECT customer_id, round({money_sql('account_balance')}, 6) AS account_balance FROM dirty",
)
def clean_numeric(spark, sf_dir):
    df = convert_numbers(dirty_customer(spark, sf_dir), ["account_balance"])
    return df.select("customer_id", F.round("account_balance", 6).alias("account_balance"))


@query(
    "clean_dates",
    DIRTY_CTE
    + f" SELECT customer_id, strftime({date_sql('signup_date')}, '%Y-%m-%d %H:%M:%S') AS signup_date FROM dirty",
)
def clean_dates(spark, sf_dir):
    df = convert_dates(dirty_customer(spark, sf_dir), ["signup_date"])
    return stamped(df).select("customer_id", "signup_date")


@query(
    "clean_invalid_counts",
    UNIQUE_CTE
    + f""" SELECT 'number' AS kind, 'account_balance' AS "column", CAST(count(*) AS BIGINT) AS invalid FROM uniq
    WHERE account_balance IS NOT NULL AND ({money_sql('account_balance')}) IS NULL
    UNION ALL SELECT 'date', 'signup_date', CAST(count(*) AS BIGINT) FROM uniq
    WHERE signup_date IS NOT NULL AND {date_sql('signup_date')} IS NULL""",
)
def clean_invalid_counts(spark, sf_dir):
    return invalid_counts(dirty_customer(spark, sf_dir, messy=True), SPEC)


@query("clean_table", CLEAN_CTE + " SELECT * FROM cleaned")
def clean_table_query(spark, sf_dir):
    return stamped(clean_table(dirty_customer(spark, sf_dir, messy=True), SPEC))


@query(
    "clean_row_accounting",
    UNIQUE_CTE
    + """ SELECT CAST(a AS BIGINT) AS input_rows, CAST(a - b AS BIGINT) AS empty_rows_removed,
    CAST(b - c AS BIGINT) AS duplicate_rows_removed, CAST(c AS BIGINT) AS output_rows
    FROM (SELECT (SELECT count(*) FROM texted) AS a, (SELECT count(*) FROM kept) AS b,
                 (SELECT count(*) FROM uniq) AS c)""",
)
def clean_row_accounting(spark, sf_dir):
    return row_accounting(dirty_customer(spark, sf_dir, messy=True), SPEC)


def _prepared(spark, sf_dir, fatal=False):
    """Source file with messy names, then the whole preparation flow."""
    source = scratch_path(spark, "source.parquet")
    write_table(dirty_customer(spark, sf_dir, messy=True), source)
    return prepare_path(
        spark,
        source,
        scratch_path(spark, "raw"),
        scratch_path(spark, "cleaned.parquet"),
        ValidationRules(required_columns=DIRTY_COLUMNS),
        SPEC,
        repeats_are_fatal=fatal,
    )


@query("prepare_pipeline", CLEAN_CTE + " SELECT * FROM cleaned")
def prepare_pipeline(spark, sf_dir):
    done = _prepared(spark, sf_dir)
    return stamped(read_table(spark, done.cleaned_path))


@query(
    "prepare_pipeline_report",
    CLEAN_CTE
    + """, sizes AS (SELECT (SELECT count(*) FROM dirty) AS a, (SELECT count(*) FROM kept) AS b,
      (SELECT count(*) FROM uniq) AS c, (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS d,
      (SELECT count(*) FROM (SELECT DISTINCT * FROM cleaned)) AS e,
      (SELECT count(*) - count(account_balance) FROM cleaned) AS g)
    SELECT CAST(a - d AS BIGINT) AS raw_duplicates, CAST(a - b AS BIGINT) AS empty_rows_removed,
    CAST(b - c AS BIGINT) AS duplicate_rows_removed, CAST(c AS BIGINT) AS cleaned_rows,
    CAST(c - e AS BIGINT) AS cleaned_duplicates, CAST(g AS BIGINT) AS missing_balances,
    CASE WHEN c - e > 0 THEN 'rejected' ELSE 'accepted' END AS strict_decision FROM sizes""",
)
def prepare_pipeline_report(spark, sf_dir):
    done = _prepared(spark, sf_dir)
    try:
        _prepared(spark, sf_dir, fatal=True)
        decision = "accepted"
    except ValidationFailure:
        decision = "rejected"
    row = (
        done.raw_report.duplicate_rows,
        done.cleaning.empty_rows_removed,
        done.cleaning.duplicate_rows_removed,
        done.cleaned_report.rows,
        done.cleaned_report.duplicate_rows,
        done.cleaning.missing_values["account_balance"],
        decision,
    )
    return small_table(
        spark,
        [row],
        "raw_duplicates bigint, empty_rows_removed bigint, duplicate_rows_removed bigint, "
        "cleaned_rows bigint, cleaned_duplicates bigint, missing_balances bigint, "
        "strict_decision string",
    )


@query(
    "complete_rows",
    UNIQUE_CTE + " SELECT * FROM uniq WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in DIRTY_COLUMNS),
)
def complete_rows_query(spark, sf_dir):
    return complete_rows(trimmed_rows(dirty_customer(spark, sf_dir), SPEC))


@query(
    "rows_with_missing",
    UNIQUE_CTE + " SELECT * FROM uniq WHERE " + " OR ".join(f"{c} IS NULL" for c in DIRTY_COLUMNS),
)
def rows_with_missing(spark, sf_dir):
    return incomplete_rows(trimmed_rows(dirty_customer(spark, sf_dir), SPEC))




@query("dedupe_rare", UNIQUE_CTE + " SELECT * FROM uniq")
def dedupe_rare(spark, sf_dir):
    spec = CleaningSpec(rare_duplicates=True)
    return trimmed_rows(dirty_customer(spark, sf_dir), spec)
