"""Features, splits, preprocessing statistics, metrics and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators.counts import modes, value_counts
from tabwright.operators.features import FeaturePlan, FeatureRecipe, feature_table
from tabwright.operators.metrics import (
    class_report,
    confusion_matrix,
    log_loss,
    prediction_counts,
    quality_gate,
    summary_metrics,
    true_class_probability,
    unknown_labels,
)
from tabwright.operators.preprocess import (
    class_weights,
    empty_features,
    fit_preprocessing,
    scale_statistics,
    wide_features,
)
from tabwright.operators.quantiles import exact_medians
from tabwright.operators.score import (
    prediction_distribution,
    probability_table,
    rule_counts,
    with_confidence,
)
from tabwright.operators.split import (
    SplitSpec,
    class_counts,
    feasibility,
    split_sizes,
    split_table,
    with_quotas,
)
from tabwright.plans.inference import inference_features
from tabwright.plans.training import build_features
from tabwright.session import scratch_path, small_table
from tabwright.sources.tables import read_table
from tabwright.workloads.registry import (
    GAPS_CTE,
    SALES_CTE,
    query,
    sales,
    sales_with_gaps,
    shared_sql,
    table,
)


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- features ---------------------------------------------------------------
@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS o_orderdate_year,
    CAST(month(o_orderdate) AS INT) AS o_orderdate_month,
    CAST(quarter(o_orderdate) AS INT) AS o_orderdate_quarter,
    CAST(isodow(o_orderdate) - 1 AS INT) AS o_orderdate_day_of_week FROM orders""",
)
def date_parts_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return feature_table(orders, FeatureRecipe(date_columns=("o_orderdate",)))


@query(
    "date_parts_kept",
    """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
    CAST(year(l_shipdate) AS INT) AS l_shipdate_year, CAST(month(l_shipdate) AS INT) AS l_shipdate_month,
    CAST(quarter(l_shipdate) AS INT) AS l_shipdate_quarter,
    CAST(isodow(l_shipdate) - 1 AS INT) AS l_shipdate_day_of_week FROM lineitem""",
)
def date_parts_kept(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    df = feature_table(items, FeatureRecipe(date_columns=("l_shipdate",), keep_date_columns=True))
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query(
    "age_from_year",
    SALES_CTE
    + """ SELECT o_orderkey, order_year, CASE WHEN 1998 - order_year >= 0
    THEN CAST(1998 - order_year AS BIGINT) END AS order_year_age FROM sales""",
)
def age_from_year(spark, sf_dir):
    df = sales(spark, sf_dir).select("o_orderkey", "order_year")
    return feature_table(
        df, FeatureRecipe(age_from_year_columns=("order_year",), reference_year=1998)
    )


@query(
    "log_features",
    """SELECT c_custkey, c_acctbal,
    CASE WHEN c_acctbal >= 0 THEN round(ln(1 + c_acctbal), 6) END AS c_acctbal_log1p FROM customer""",
)
def log_features(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(feature_table(df, FeatureRecipe(log_columns=("c_acctbal",))), "c_acctbal_log1p")


RATIOS = ("price_per_discount=l_extendedprice/l_discount", "relative_tax=l_tax/price_per_discount")


@query(
    "ratio_features",
    """SELECT l_orderkey, l_linenumber, round(r, 6) AS price_per_discount,
    CASE WHEN r <> 0 THEN round(l_tax / r, 6) END AS relative_tax
    FROM (SELECT *, CASE WHEN l_discount <> 0 THEN l_extendedprice / l_discount END AS r FROM lineitem)""",
)
def ratio_features(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"
    )
    df = feature_table(items, FeatureRecipe(ratio_features=RATIOS))
    return rounded(df, "price_per_discount", "relative_tax").drop(
        "l_extendedprice", "l_discount", "l_tax"
    )


SALES_RECIPE = FeatureRecipe(
    target_column="o_orderpriority",
    drop_columns=("o_orderstatus",),
    date_columns=("o_orderdate",),
    age_from_year_columns=("order_year",),
    reference_year=1998,
    log_columns=("c_acctbal", "o_totalprice"),
    ratio_features=("price_to_balance=o_totalprice/c_acctbal", "price_by_region=o_totalprice/n_regionkey"),
)


def _target_gaps(spark, sf_dir):
    """Sales with some targets missing."""
    df = sales(spark, sf_dir)
    return df.withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 10 != 3, F.col("o_orderpriority"))
    )


TARGET_GAPS_CTE = SALES_CTE + """, gapped AS (SELECT * REPLACE (
  CASE WHEN o_orderkey % 10 <> 3 THEN o_orderpriority END AS o_orderpriority) FROM sales)"""


@query(
    "feature_warnings",
    TARGET_GAPS_CTE
    + "".join(
        f"""{' UNION ALL' if i else ''} SELECT '{rule}' AS rule, '{column}' AS "column",
        CAST(count(*) AS BIGINT) AS rows FROM gapped WHERE {test}"""
        for i, (rule, column, test) in enumerate(
            (
                ("future_year", "order_year", "order_year > 1998"),
                ("not_a_number", "c_acctbal", "false"),
                ("negative_log", "c_acctbal", "c_acctbal < 0"),
                ("not_a_number", "o_totalprice", "false"),
                ("negative_log", "o_totalprice", "o_totalprice < 0"),
                ("zero_denominator", "price_to_balance", "c_acctbal = 0"),
                ("zero_denominator", "price_by_region", "n_regionkey = 0"),
                ("missing_target", "o_orderpriority", "o_orderpriority IS NULL"),
            )
        )
    ),
)
def feature_warnings(spark, sf_dir):
    return FeaturePlan(_target_gaps(spark, sf_dir), SALES_RECIPE).warning_counts()


@query(
    "feature_table",
    TARGET_GAPS_CTE
    + """ SELECT o_orderkey, o_totalprice, o_orderpriority, order_year, c_acctbal, c_mktsegment,
    n_name, n_regionkey, CAST(year(o_orderdate) AS INT) AS o_orderdate_year,
    CAST(month(o_orderdate) AS INT) AS o_orderdate_month,
    CAST(quarter(o_orderdate) AS INT) AS o_orderdate_quarter,
    CAST(isodow(o_orderdate) - 1 AS INT) AS o_orderdate_day_of_week,
    CASE WHEN 1998 - order_year >= 0 THEN 1998 - order_year END AS order_year_age,
    CASE WHEN c_acctbal >= 0 THEN round(ln(1 + c_acctbal), 6) END AS c_acctbal_log1p,
    CASE WHEN o_totalprice >= 0 THEN round(ln(1 + o_totalprice), 6) END AS o_totalprice_log1p,
    CASE WHEN c_acctbal <> 0 THEN round(o_totalprice / c_acctbal, 6) END AS price_to_balance,
    CASE WHEN n_regionkey <> 0 THEN round(o_totalprice / n_regionkey, 6) END AS price_by_region
    FROM gapped WHERE o_orderpriority IS NOT NULL""",
)
def feature_table_query(spark, sf_dir):
    df = feature_table(_target_gaps(spark, sf_dir), SALES_RECIPE)
    return rounded(
        df, "c_acctbal_log1p", "o_totalprice_log1p", "price_to_balance", "price_by_region"
    )


@query(
    "inference_features",
    SALES_CTE
    + """ SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
    o_orderpriority, order_year, c_acctbal, c_mktsegment, n_name, n_regionkey,
    CAST(isodow(o_orderdate) - 1 AS INT) AS o_orderdate_day_of_week,
    CASE WHEN 1998 - order_year >= 0 THEN 1998 - order_year END AS order_year_age,
    CASE WHEN c_acctbal <> 0 THEN round(o_totalprice / c_acctbal, 6) END AS price_to_balance FROM sales""",
)
def inference_features_query(spark, sf_dir):
    """A stored recipe applied to rows to score: originals stay, no row is lost."""
    manifest = {
        "feature_build_config": SALES_RECIPE.to_manifest(),
        "expected_feature_columns": ["order_year_age", "price_to_balance"],
    }
    frame, _ = inference_features(sales(spark, sf_dir), manifest)
    return (
        rounded(frame, "price_to_balance")
        .withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .drop(
            "o_orderdate_year", "o_orderdate_month", "o_orderdate_quarter",
            "c_acctbal_log1p", "o_totalprice_log1p", "price_by_region",
        )
    )


# --- splits -----------------------------------------------------------------
SPLIT = SplitSpec(target_column="o_orderpriority", key_columns=("o_orderkey",))


def quota_sql(rows):
    """Largest-remainder quotas 0.70/0.15/0.15 of ``n`` rows per class."""
    return f"""
  exact AS (SELECT *, 0.7::DOUBLE * n AS e1, 0.15::DOUBLE * n AS e2, 0.15::DOUBLE * n AS e3 FROM ({rows})),
  parts AS (SELECT *, floor(e1) AS f1, floor(e2) AS f2, floor(e3) AS f3,
    e1 - floor(e1) AS r1, e2 - floor(e2) AS r2, e3 - floor(e3) AS r3 FROM exact),
  quotas AS (SELECT *, n - f1 - f2 - f3 AS spare,
    (r2 > r1)::INT + (r3 > r1)::INT AS b1, (r1 >= r2)::INT + (r3 > r2)::INT AS b2,
    (r1 >= r3)::INT + (r2 >= r3)::INT AS b3 FROM parts),
  shares AS (SELECT class, n, CAST(f1 + (b1 < spare)::INT AS BIGINT) AS train,
    CAST(f2 + (b2 < spare)::INT AS BIGINT) AS validation,
    CAST(f3 + (b3 < spare)::INT AS BIGINT) AS test FROM quotas)"""


BY_PRIORITY = "SELECT o_orderpriority AS class, count(*) AS n FROM orders GROUP BY o_orderpriority"
IN_ALL = "SELECT 'all rows' AS class, count(*) AS n FROM orders"


def _split_sql(rows, class_sql, seed=42):
    return f"""WITH {quota_sql(rows)},
  ranked AS (SELECT o_orderkey, {class_sql} AS class, row_number() OVER (
    PARTITION BY {class_sql} ORDER BY md5('{seed}|' || length(o_orderkey::VARCHAR) || ':' || o_orderkey)) AS place FROM orders)
  SELECT o_orderkey, ranked.class, CASE WHEN place <= train THEN 'train'
    WHEN place <= train + validation THEN 'validation' ELSE 'test' END AS split
  FROM ranked JOIN shares ON ranked.class = shares.class"""


@query(
    "split_quotas",
    f"WITH {quota_sql(BY_PRIORITY)} SELECT class, CAST(n AS BIGINT) AS n, train, validation, test FROM shares",
)
def split_quotas(spark, sf_dir):
    counts = class_counts(table(spark, sf_dir, "orders"), "o_orderpriority")
    return with_quotas(counts, SPLIT.fractions)


@query("split_stratified", _split_sql(BY_PRIORITY, "o_orderpriority"))
def split_stratified(spark, sf_dir):
    result = split_table(table(spark, sf_dir, "orders"), SPLIT)
    return result.frame.select("o_orderkey", F.col("o_orderpriority").alias("class"), "split")


@query("split_random", _split_sql(IN_ALL, "'all rows'", 7))
def split_random(spark, sf_dir):
    spec = SplitSpec(seed=7, key_columns=("o_orderkey",))
    frame = split_table(table(spark, sf_dir, "orders"), spec).frame
    return frame.select("o_orderkey", F.lit("all rows").alias("class"), "split")


# One customer segment holds many orders; keys that repeat must still give exact
# quotas, which the sizes show.
@query(
    "split_repeated_keys",
    f"""WITH {quota_sql("SELECT 'all rows' AS class, count(*) AS n FROM lineitem")}
    SELECT 'train' AS split, train AS rows FROM shares UNION ALL
    SELECT 'validation', validation FROM shares UNION ALL SELECT 'test', test FROM shares""",
)
def split_repeated_keys(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    frame = split_table(items, SplitSpec(key_columns=("l_returnflag",))).frame
    return frame.groupBy("split").agg(F.count("*").alias("rows"))


def _sizes_sql(rows):
    return f"""WITH {quota_sql(rows)}
    SELECT 'train' AS split, train AS rows FROM shares UNION ALL
    SELECT 'validation', validation FROM shares UNION ALL SELECT 'test', test FROM shares"""


IN_LINES = "SELECT 'all rows' AS class, count(*) AS n FROM lineitem"


@query("split_null_keys", _sizes_sql(IN_LINES))
def split_null_keys(spark, sf_dir):
    """Whole rows as keys: many copies, and missing values that change places."""
    items = table(spark, sf_dir, "lineitem")
    odd = F.col("l_linenumber") % 2 == 1
    rows = items.select(
        F.when(odd, F.col("l_returnflag")).alias("a"), F.when(~odd, F.col("l_returnflag")).alias("b")
    )
    frame = split_table(rows, SplitSpec()).frame
    return frame.groupBy("split").agg(F.count("*").alias("rows"))


@query("split_colliding_keys", _sizes_sql(IN_LINES))
def split_colliding_keys(spark, sf_dir):
    """Keys whose texts are the same once they are joined by a bar."""
    items = table(spark, sf_dir, "lineitem")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    odd = F.col("l_linenumber") % 2 == 1
    rows = items.select(
        F.when(odd, F.concat(flag, F.lit("|"), status)).otherwise(flag).alias("a"),
        F.when(odd, F.lit("x")).otherwise(F.concat(status, F.lit("|x"))).alias("b"),
        "l_orderkey",
        "l_linenumber",
    )
    frame = split_table(rows, SplitSpec(key_columns=("a", "b"))).frame
    return frame.groupBy("split").agg(F.count("*").alias("rows"))


@query(
    "split_sizes",
    f"""WITH {quota_sql(BY_PRIORITY)} SELECT 'train' AS split, CAST(sum(train) AS BIGINT) AS rows FROM shares
    UNION ALL SELECT 'validation', CAST(sum(validation) AS BIGINT) FROM shares
    UNION ALL SELECT 'test', CAST(sum(test) AS BIGINT) FROM shares""",
)
def split_sizes_query(spark, sf_dir):
    return split_sizes(split_table(table(spark, sf_dir, "orders"), SPLIT))


def _feasible_sql(column):
    return f"""SELECT '{column}' AS target, CAST(sum(n) AS BIGINT) AS rows,
    CAST(count(*) AS BIGINT) AS classes, CAST(min(n) AS BIGINT) AS smallest,
    CAST(greatest(20, floor(sqrt(sum(n)))) AS BIGINT) AS class_limit,
    CASE WHEN count(*) < 2 THEN 'few_classes'
      WHEN count(*) > greatest(20, floor(sqrt(sum(n)))) THEN 'many_classes'
      WHEN min(n) < 3 THEN 'small_class' ELSE '' END AS reason
    FROM (SELECT {column}, count(*) AS n FROM orders GROUP BY {column})"""


@query(
    "feature_dataset",
    f"""WITH {quota_sql(BY_PRIORITY)},
  ranked AS (SELECT *, row_number() OVER (
    PARTITION BY o_orderpriority ORDER BY md5('42|' || length(o_orderkey::VARCHAR) || ':' || o_orderkey)) AS place FROM orders)
  SELECT o_orderkey, o_orderpriority, CASE WHEN place <= train THEN 'train'
    WHEN place <= train + validation THEN 'validation' ELSE 'test' END AS split,
    CAST(year(o_orderdate) AS INT) AS o_orderdate_year,
    CASE WHEN o_totalprice >= 0 THEN round(ln(1 + o_totalprice), 6) END AS o_totalprice_log1p
  FROM ranked JOIN shares ON o_orderpriority = class""",
)
def feature_dataset(spark, sf_dir):
    """Features built, split and written as one partitioned table, then read back."""
    recipe = FeatureRecipe(
        target_column="o_orderpriority",
        drop_columns=("o_custkey", "o_orderstatus"),
        date_columns=("o_orderdate",),
        log_columns=("o_totalprice",),
    )
    output = scratch_path(spark, "features.parquet")
    source = f"{sf_dir.rstrip('/')}/orders.parquet"
    build_features(spark, source, output, recipe, SplitSpec(key_columns=("o_orderkey",)))
    return rounded(read_table(spark, output), "o_totalprice_log1p").select(
        "o_orderkey", "o_orderpriority", "split", "o_orderdate_year", "o_totalprice_log1p"
    )


@query(
    "split_feasibility",
    " UNION ALL ".join(_feasible_sql(c) for c in ("o_orderpriority", "o_orderstatus", "o_custkey")),
)
def split_feasibility(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parts = [
        feasibility(class_counts(orders, c), 3).select(
            F.lit(c).alias("target"), "rows", "classes", "smallest", "class_limit", "reason"
        )
        for c in ("o_orderpriority", "o_orderstatus", "o_custkey")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- preprocessing ----------------------------------------------------------
@query(
    "class_weights",
    f"""SELECT class, CAST(n AS BIGINT) AS n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
    FROM ({BY_PRIORITY})""",
)
def class_weights_query(spark, sf_dir):
    counts = class_counts(table(spark, sf_dir, "orders"), "o_orderpriority")
    return rounded(class_weights(counts), "weight")


NUMERIC = ("o_totalprice", "c_acctbal")
CATEGORICAL = ("c_mktsegment", "n_name")


@query(
    "impute_median",
    GAPS_CTE
    + """ SELECT o_orderkey, round(coalesce(o_totalprice, (SELECT median(o_totalprice) FROM gaps)), 6) AS o_totalprice,
    round(coalesce(c_acctbal, (SELECT median(c_acctbal) FROM gaps)), 6) AS c_acctbal FROM gaps""",
)
def impute_median(spark, sf_dir):
    df = sales_with_gaps(spark, sf_dir)
    medians = exact_medians(df, NUMERIC)
    filled = {c: F.round(F.coalesce(F.col(c), F.lit(medians[c])), 6) for c in NUMERIC}
    return df.withColumns(filled).select("o_orderkey", *NUMERIC)


SCALED = "(coalesce({c}, (SELECT median({c}) FROM gaps)))"


@query(
    "scale_standard",
    GAPS_CTE
    + ", filled AS (SELECT o_orderkey, "
    + ", ".join(f"{SCALED.format(c=c)} AS {c}" for c in NUMERIC)
    + ") SELECT o_orderkey, ".replace(")", " FROM gaps)", 1)
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled), 6) AS {c}"
        for c in NUMERIC
    )
    + " FROM filled",
)
def scale_standard(spark, sf_dir):
    df = sales_with_gaps(spark, sf_dir)
    plan = fit_preprocessing(df, NUMERIC, ())
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select("o_orderkey", *[F.round(plan.scaled(c, types[c]), 6).alias(c) for c in NUMERIC])


@query(
    "scale_statistics",
    GAPS_CTE
    + ", filled AS (SELECT "
    + ", ".join(f"{SCALED.format(c=c)} AS {c}" for c in NUMERIC)
    + " FROM gaps) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std,
        round(stddev_pop({c}), 4) AS scale FROM filled"""
        for c in NUMERIC
    ),
)
def scale_statistics_query(spark, sf_dir):
    df = sales_with_gaps(spark, sf_dir)
    stats = scale_statistics(df, exact_medians(df, NUMERIC))
    return stats.select("column", *[F.round(c, 4).alias(c) for c in ("mean", "std", "scale")])


@query(
    "impute_mode",
    GAPS_CTE
    + " SELECT o_orderkey, "
    + ", ".join(
        f"""coalesce({c}, (SELECT {c} FROM gaps WHERE {c} IS NOT NULL GROUP BY {c}
        ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"""
        for c in CATEGORICAL
    )
    + " FROM gaps",
)
def impute_mode(spark, sf_dir):
    df = sales_with_gaps(spark, sf_dir)
    # one row per column
    top = {r["column"]: r["value"] for r in modes(value_counts(df, CATEGORICAL)).collect()}
    return df.select(
        "o_orderkey", *[F.coalesce(F.col(c), F.lit(top[c])).alias(c) for c in CATEGORICAL]
    )


@query(
    "onehot_long",
    GAPS_CTE
    + ", filled AS (SELECT o_orderkey, "
    + ", ".join(
        f"""coalesce({c}, (SELECT {c} FROM gaps WHERE {c} IS NOT NULL GROUP BY {c}
        ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"""
        for c in CATEGORICAL
    )
    + """ FROM gaps),
    seg AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS slot
            FROM (SELECT DISTINCT c_mktsegment FROM gaps WHERE c_mktsegment IS NOT NULL)),
    nat AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 + (SELECT count(*) FROM seg) AS slot
            FROM (SELECT DISTINCT n_name FROM gaps WHERE n_name IS NOT NULL))
    SELECT o_orderkey, CAST(slot AS BIGINT) AS slot FROM filled JOIN seg USING (c_mktsegment)
    UNION ALL SELECT o_orderkey, CAST(slot AS BIGINT) FROM filled JOIN nat USING (n_name)""",
)
def onehot_long(spark, sf_dir):
    """The active slot of each category, from its index and the widths before it."""
    from pyspark.ml import PipelineModel

    df = sales_with_gaps(spark, sf_dir)
    plan = fit_preprocessing(df, (), CATEGORICAL)
    coded = PipelineModel(plan.transformers(df)).transform(df)
    slots, before = [], 0
    for i, c in enumerate(CATEGORICAL):
        width = len(plan.categories[c])
        index = F.col(f"tw_idx_{i}")
        slots.append(F.when(index < width, index + before).cast("bigint"))
        before += width
    return coded.select("o_orderkey", F.explode(F.array(*slots)).alias("slot")).filter("slot is not null")


@query(
    "high_cardinality",
    """SELECT 'c_name' AS "column", CAST(count(DISTINCT c_name) AS BIGINT) AS n_distinct FROM customer
    HAVING count(DISTINCT c_name) > 100 AND count(DISTINCT c_name) > 0.5 * count(*)
    UNION ALL SELECT 'c_mktsegment', CAST(count(DISTINCT c_mktsegment) AS BIGINT) FROM customer
    HAVING count(DISTINCT c_mktsegment) > 100 AND count(DISTINCT c_mktsegment) > 0.5 * count(*)""",
)
def high_cardinality(spark, sf_dir):
    found = wide_features(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])
    return small_table(spark, list(found.items()), "column string, n_distinct bigint")


@query(
    "all_missing_features",
    """SELECT "column" FROM (SELECT 'c_name' AS "column", count(c_name) AS n FROM customer
    UNION ALL SELECT 'never_filled', count(CASE WHEN c_custkey < 0 THEN c_name END) FROM customer) WHERE n = 0""",
)
def all_missing_features(spark, sf_dir):
    df = table(spark, sf_dir, "customer").withColumn(
        "never_filled", F.when(F.col("c_custkey") < 0, F.col("c_name"))
    )
    return small_table(
        spark, [(c,) for c in empty_features(df, ["c_name", "never_filled"])], "column string"
    )


# --- metrics ----------------------------------------------------------------
CLASSES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
# A fixed rule stands for a model: it calls four of the five classes, so one
# class has no predictions, and gives every class a probability.
RULED_SQL = """
SELECT o_orderkey, o_orderpriority AS label,
  CASE CAST(floor(o_totalprice) AS BIGINT) % 6 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH'
    WHEN 2 THEN '3-MEDIUM' WHEN 3 THEN '5-LOW' ELSE CASE WHEN o_orderpriority = '4-NOT SPECIFIED'
    THEN '5-LOW' ELSE o_orderpriority END END AS prediction,
  w1 / (w1 + w2 + w3 + w4 + w5) AS p1, w2 / (w1 + w2 + w3 + w4 + w5) AS p2,
  w3 / (w1 + w2 + w3 + w4 + w5) AS p3, w4 / (w1 + w2 + w3 + w4 + w5) AS p4,
  w5 / (w1 + w2 + w3 + w4 + w5) AS p5
FROM (SELECT *, CAST(o_orderkey % 11 AS DOUBLE) AS w1, CAST(1 + (o_orderkey + 7) % 11 AS DOUBLE) AS w2,
  CAST(1 + (o_orderkey + 14) % 11 AS DOUBLE) AS w3, CAST(1 + (o_orderkey + 21) % 11 AS DOUBLE) AS w4,
  CAST(1 + (o_orderkey + 28) % 11 AS DOUBLE) AS w5 FROM {orders}) AS weighted
"""
RULED_CTE = "WITH ruled AS (" + RULED_SQL.replace("{orders}", "orders") + ")"
NAMES_SQL = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CLASSES))
REPORT_CTE = RULED_CTE + f""", names(position, label) AS (VALUES {NAMES_SQL}),
  truth AS (SELECT label, count(*) AS support, count(*) FILTER (label = prediction) AS hits FROM ruled GROUP BY label),
  called AS (SELECT prediction AS label, count(*) AS predicted FROM ruled GROUP BY prediction),
  report AS (SELECT position, label, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted,
      coalesce(hits, 0) AS hits FROM names LEFT JOIN truth USING (label) LEFT JOIN called USING (label)),
  scored AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END AS prec,
    CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS rec,
    CASE WHEN support + predicted > 0 THEN 2 * hits / (support + predicted)::DOUBLE ELSE 0 END AS f1 FROM report)"""


def ruled(spark, sf_dir):
    return shared_sql(spark, sf_dir, RULED_SQL, "orders")


def _counts(spark, sf_dir):
    return prediction_counts(ruled(spark, sf_dir), "label", "prediction")


@query(
    "confusion_matrix",
    RULED_CTE
    + f""", names(position, label) AS (VALUES {NAMES_SQL}),
    cells AS (SELECT label, prediction, count(*) AS n FROM ruled GROUP BY label, prediction)
    SELECT a.label, b.label AS prediction, CAST(coalesce(n, 0) AS BIGINT) AS n FROM names a, names b
    LEFT JOIN cells ON cells.label = a.label AND cells.prediction = b.label""",
)
def confusion_matrix_query(spark, sf_dir):
    return confusion_matrix(_counts(spark, sf_dir), CLASSES)


@query(
    "class_report",
    REPORT_CTE
    + """ SELECT label, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1,
    CAST(support AS BIGINT) AS support FROM scored""",
)
def class_report_query(spark, sf_dir):
    report = class_report(_counts(spark, sf_dir), CLASSES)
    return rounded(report, "precision", "recall", "f1").select(
        "label", "precision", "recall", "f1", "support"
    )


SUMMARY_SQL = REPORT_CTE + """ SELECT round(sum(hits) / sum(support)::DOUBLE, 6) AS accuracy,
    round(avg(CASE WHEN support > 0 THEN rec END), 6) AS balanced_accuracy,
    round(sum(prec * support) / sum(support), 6) AS precision_weighted,
    round(sum(rec * support) / sum(support), 6) AS recall_weighted,
    round(sum(f1 * support) / sum(support), 6) AS f1_weighted,
    round(avg(prec), 6) AS precision_macro, round(avg(rec), 6) AS recall_macro,
    round(avg(f1), 6) AS f1_macro, CAST(sum(support) AS BIGINT) AS support FROM scored"""
SUMMARY_COLUMNS = (
    "accuracy", "balanced_accuracy", "precision_weighted", "recall_weighted", "f1_weighted",
    "precision_macro", "recall_macro", "f1_macro",
)


@query("summary_metrics", SUMMARY_SQL)
def summary_metrics_query(spark, sf_dir):
    report = class_report(_counts(spark, sf_dir), CLASSES)
    return rounded(summary_metrics(report), *SUMMARY_COLUMNS)


@query(
    "log_loss",
    RULED_CTE
    + """ SELECT round(avg(-ln(greatest(least(CASE label WHEN '1-URGENT' THEN p1 WHEN '2-HIGH' THEN p2
    WHEN '3-MEDIUM' THEN p3 WHEN '4-NOT SPECIFIED' THEN p4 ELSE p5 END,
    1 - 2.220446049250313e-16), 2.220446049250313e-16))), 6) AS log_loss FROM ruled""",
)
def log_loss_query(spark, sf_dir):
    p = true_class_probability(F.col("label"), CLASSES, F.array("p1", "p2", "p3", "p4", "p5"))
    return rounded(log_loss(ruled(spark, sf_dir), p), "log_loss")


@query(
    "unknown_labels",
    RULED_CTE
    + " SELECT label, CAST(count(*) AS BIGINT) AS n FROM ruled WHERE label NOT IN ('1-URGENT', '2-HIGH') GROUP BY label",
)
def unknown_labels_query(spark, sf_dir):
    return unknown_labels(_counts(spark, sf_dir), CLASSES[:2])


@query(
    "quality_gate",
    f"""SELECT metric_name, metric_value, minimum_value, metric_value >= minimum_value AS passed,
    CASE WHEN metric_value >= minimum_value THEN 'approved' ELSE 'rejected' END AS decision FROM (
      SELECT 'f1_weighted' AS metric_name, f1_weighted AS metric_value, 0.7::DOUBLE AS minimum_value FROM ({SUMMARY_SQL})
      UNION ALL SELECT 'accuracy', accuracy, 0.2::DOUBLE FROM ({SUMMARY_SQL}))""",
)
def quality_gate_query(spark, sf_dir):
    metrics = summary_metrics_query(spark, sf_dir)
    return quality_gate(metrics, "f1_weighted", 0.7).unionByName(
        quality_gate(metrics, "accuracy", 0.2)
    )


# --- report tables of scored rows -------------------------------------------
@query(
    "prediction_distribution",
    RULED_CTE + " SELECT prediction, CAST(count(*) AS BIGINT) AS n FROM ruled GROUP BY prediction",
)
def prediction_distribution_query(spark, sf_dir):
    return prediction_distribution(ruled(spark, sf_dir), "prediction")


PROBABILITIES = ("p1", "p2", "p3", "p4", "p5")


@query(
    "probability_table",
    RULED_CTE
    + " UNION ALL ".join(
        f" SELECT o_orderkey, '{c}' AS class, round({p}, 6) AS probability FROM ruled"
        for c, p in zip(CLASSES, PROBABILITIES)
    ),
)
def probability_table_query(spark, sf_dir):
    long = probability_table(ruled(spark, sf_dir), ["o_orderkey"], PROBABILITIES, CLASSES)
    return rounded(long, "probability")


@query(
    "top_confidence",
    RULED_CTE + " SELECT o_orderkey, round(greatest(p1, p2, p3, p4, p5), 6) AS confidence FROM ruled",
)
def top_confidence(spark, sf_dir):
    df = with_confidence(ruled(spark, sf_dir), PROBABILITIES)
    return rounded(df, "confidence").select("o_orderkey", "confidence")


@query(
    "cross_column_rules",
    """SELECT 'zero_discount' AS rule, CAST(count(*) FILTER (l_discount = 0) AS BIGINT) AS rows FROM lineitem
    UNION ALL SELECT 'tax_over_discount', CAST(count(*) FILTER (l_tax > l_discount) AS BIGINT) FROM lineitem""",
)
def cross_column_rules(spark, sf_dir):
    return rule_counts(
        table(spark, sf_dir, "lineitem"),
        {
            "zero_discount": F.col("l_discount") == 0,
            "tax_over_discount": F.col("l_tax") > F.col("l_discount"),
        },
    )
