import pytest
from conftest import as_set
from pyspark.sql import functions as F

from tabwright.errors import StrictInputError, ValidationFailure
from tabwright.operators.clean import (
    CleaningSpec,
    clean_table,
    clean_with_report,
    complete_rows,
    incomplete_rows,
)
from tabwright.operators.counts import (
    distinct_counts,
    missing_counts,
    modes,
    top_categories,
    value_counts,
)
from tabwright.operators.duplicates import duplicate_count, repeated_rows
from tabwright.operators.rownum import number_rows
from tabwright.operators.schema import (
    normalize_columns,
    nulls_only,
    profile_roles,
    training_roles,
)
from tabwright.operators.validate import ValidationRules, validate_table, validation_findings
from tabwright.plans.prepare import clean_path, prepare_path, prepare_table
from tabwright.sources.files import protect_outputs, read_json, write_json
from tabwright.sources.strict import (
    StrictSpec,
    checked_header,
    input_template,
    read_strict_csv,
    violations,
)
from tabwright.sources.tables import read_table, table_format, write_table
from tabwright.sources.zones import ingest


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(
        [(" S001 ", " High ", "$1,000"), (" S001 ", "High", "$1,000"), (None, "null", "")],
        "`Company ID` string, `AI Adoption Level` string, `Funding USD` string",
    )


SPEC = CleaningSpec(numeric_columns=("funding_usd",))


def test_clean_dirty_table(dirty):
    before = dirty.collect()
    cleaned, report = clean_with_report(dirty, SPEC)
    assert cleaned.columns == ["company_id", "ai_adoption_level", "funding_usd"]
    assert as_set(cleaned) == [("S001", "High", 1000.0)]
    assert (report.input_rows, report.output_rows) == (3, 1)
    assert (report.empty_rows_removed, report.duplicate_rows_removed) == (1, 1)
    assert report.renamed_columns["Company ID"] == "company_id"
    assert dirty.collect() == before
    assert "3 -> 1" in report.summary()


def test_clean_is_idempotent(dirty):
    once = clean_table(dirty, SPEC)
    assert as_set(clean_table(once, SPEC)) == as_set(once)


def test_repeats_go_before_numbers_are_parsed(spark):
    df = spark.createDataFrame([("$1,000",), ("1000",), ("x",)], "v string")
    cleaned, report = clean_with_report(df, CleaningSpec(numeric_columns=("v",)))
    assert sorted(r[0] or -1 for r in cleaned.collect()) == [-1, 1000.0, 1000.0]
    assert report.invalid_numbers == {"v": 1}
    assert report.missing_values == {"v": 1}


def test_clean_options_and_empty_input(spark, dirty):
    keep = CleaningSpec(drop_empty_rows=False, drop_duplicate_rows=False)
    assert clean_table(dirty, keep).count() == 3
    cleaned, report = clean_with_report(dirty.limit(0), SPEC)
    assert cleaned.count() == 0 and report.input_rows == 0
    with pytest.raises(ValueError, match="absent"):
        clean_table(dirty, CleaningSpec(numeric_columns=("absent",)))


def test_same_result_for_any_partitioning(spark, dirty):
    assert as_set(clean_table(dirty.repartition(16), SPEC)) == as_set(
        clean_table(dirty.coalesce(1), SPEC)
    )


def test_names_must_stay_distinct(spark):
    with pytest.raises(ValueError, match="same name"):
        normalize_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a-B` int"))
    with pytest.raises(ValueError, match="nothing is left"):
        normalize_columns(spark.createDataFrame([(1,)], "`%` int"))


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert missing_counts(df).first()["missing"] == 2
    assert nulls_only(df).filter("x is null").count() == 2
    assert complete_rows(df).count() == 1 and incomplete_rows(df).count() == 2


def test_roles(spark):
    df = spark.createDataFrame([], "a int, b boolean, c string, d timestamp, y string")
    assert training_roles(df, "y") == (["a", "b"], ["c", "d"])
    assert profile_roles(df, "y") == (["a"], ["b", "c"])


# --- counts -----------------------------------------------------------------
def test_value_counts_and_modes(spark):
    rows = [("b", -0.0), ("a", 0.0), ("b", 1.0), ("a", None), (None, float("nan"))]
    df = spark.createDataFrame(rows, "s string, x double")
    counts = value_counts(df, ["s", "x"])
    found = {(r["column"], r["value"]): r["n"] for r in counts.collect()}
    assert found == {("s", "a"): 2, ("s", "b"): 2, ("s", None): 1, ("x", "0.0"): 2, ("x", "1.0"): 1, ("x", None): 2}
    assert {r["column"]: r["value"] for r in modes(counts).collect()} == {"s": "a", "x": "0.0"}
    assert {r["column"]: r["n_distinct"] for r in distinct_counts(df).collect()} == {"s": 2, "x": 2}


def test_real_other_category_stays_apart(spark):
    df = spark.createDataFrame([(v,) for v in ["Other"] * 3 + ["a"] * 2 + ["b", "c"]], "c string")
    top = top_categories(value_counts(df, ["c"]), 2).sort("position").collect()
    assert [(r["value"], r["n"], r["is_other"]) for r in top] == [
        ("Other", 3, False), ("a", 2, False), ("Other", 2, True)
    ]


def test_duplicates(spark):
    rows = [(1, "a"), (1, "a"), (None, None), (None, None), (None, "a"), (2, None)]
    df = spark.createDataFrame(rows, "x int, y string")
    assert duplicate_count(df).first()[0] == 2
    assert as_set(repeated_rows(df)) == sorted([(1, "a", 2), (None, None, 2)], key=str)
    assert duplicate_count(df.limit(0)).first()[0] == 0
    assert duplicate_count(spark.range(5)).first()[0] == 0


def test_row_numbers_have_no_gaps(spark):
    df = spark.range(0, 1000, 1, 13).withColumn("k", (F.col("id") * 7919) % 1000)
    n = number_rows(df, "row")
    assert sorted(r["row"] for r in n.collect()) == list(range(1000))
    ordered = number_rows(df, "row", 1, ["k"]).collect()
    assert all(r["row"] == r["k"] + 1 for r in ordered)
    assert number_rows(df.limit(0), "row").count() == 0


# --- validation -------------------------------------------------------------
def test_valid_table(spark):
    df = spark.createDataFrame(
        [("S001", "India", "Acquired"), ("S002", "USA", "Independent")],
        "company_id string, country string, status string",
    )
    rules = ValidationRules(("company_id", "country"), "status", ("Acquired", " Independent "))
    report = validate_table(df, rules)
    assert (report.rows, report.columns, report.duplicate_rows, report.warnings) == (2, 3, 0, ())
    assert validation_findings(df, rules).count() == 0


def test_every_error_is_reported(spark):
    df = spark.createDataFrame([("S001", "Unknown"), ("S001", None)], "company_id string, status string")
    rules = ValidationRules(("country",), "status", ("Acquired",), max_missing_fraction=0.4)
    with pytest.raises(ValidationFailure) as error:
        validate_table(df, rules)
    text = str(error.value)
    assert len(error.value.problems) == 4
    for part in ("country", "1 missing values", "Unknown", "0.5"):
        assert part in text
    found = {(r["rule"], r["value"]) for r in validation_findings(df, rules).collect()}
    assert found == {("required_column", ""), ("missing_target", "1"), ("unexpected_label", "Unknown"), ("missing_fraction", "0.5")}


def test_fraction_limit_is_strict(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert validate_table(df, ValidationRules(max_missing_fraction=0.5)).missing_values == {"x": 1}
    with pytest.raises(ValueError):
        ValidationRules(max_missing_fraction=1.5)


def test_repeats_warn_or_fail(spark):
    df = spark.createDataFrame([(1,), (1,)], "x int")
    assert validate_table(df, ValidationRules()).warnings == ("1 rows are repeated",)
    with pytest.raises(ValidationFailure):
        validate_table(df, ValidationRules(fail_on_duplicate_rows=True))


def test_broken_headers_and_empty_tables(spark):
    twice = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int").toDF("x", "x", " ")
    with pytest.raises(ValidationFailure) as error:
        validate_table(twice, ValidationRules(target_column="y"))
    assert len(error.value.problems) == 3
    with pytest.raises(ValidationFailure, match="no rows"):
        validate_table(spark.createDataFrame([], "x int"), ValidationRules())


# --- sources ----------------------------------------------------------------
def test_csv_types_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,x,flag,name,gone\n1,1.5,true,"a ""q"" \n b",NA\n2,N/A,False, pad ,\n3,inf,,NULL\n', encoding="utf-8")
    df = read_table(spark, str(path), multiline=True)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "boolean", "string", "double"]
    assert as_set(df) == sorted(
        [(1, 1.5, True, 'a "q" \n b', None), (2, None, False, " pad ", None), (3, float("inf"), None, None, None)],
        key=str,
    )
    typed = read_table(spark, str(path), "id int, x double, flag boolean, name string, gone string")
    assert typed.schema["id"].dataType.simpleString() == "int"


def test_roundtrips(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 0.1, " a\n\"b\", ", "2024-01-02 03:04:05"), (2, None, None, None)], "i bigint, x double, s string, t string"
    ).withColumn("t", F.to_timestamp("t"))
    for fmt in ("csv", "json", "parquet"):
        path = str(tmp_path / f"t.{fmt}")
        write_table(df, path)
        assert as_set(read_table(spark, path, df.schema, multiline=fmt == "csv")) == as_set(df), fmt
        with pytest.raises(Exception, match="(?i)exists"):
            write_table(df, path)
        write_table(df.limit(1), path, overwrite=True)


def test_formats():
    assert table_format("/a/b.CSV") == "csv"
    with pytest.raises(ValueError, match="parquet"):
        table_format("x.orc")


def test_ingest(spark, tmp_path):
    source = tmp_path / "t.csv"
    source.write_text('a,b\n 007,"x ""y"""\nNA,\n', encoding="utf-8")
    path, df = ingest(spark, str(source), str(tmp_path / "raw"))
    assert df.count() == 2
    text = [line for part in (tmp_path / "raw" / "t.csv").glob("part*") for line in part.read_text().splitlines()]
    assert text == ["a,b", ' 007,"x ""y"""', "NA,"]
    (tmp_path / "t.json").write_text('{"a": 1.50}\n', encoding="utf-8")
    assert ingest(spark, str(tmp_path / "t.json"), str(tmp_path / "raw"))[1].first()["a"] == 1.5
    with pytest.raises(FileExistsError):
        ingest(spark, str(source), str(tmp_path / "raw"))
    ingest(spark, str(source), str(tmp_path / "raw"), overwrite=True)
    with pytest.raises(FileNotFoundError):
        ingest(spark, str(tmp_path / "no.csv"), str(tmp_path / "raw"))
    (tmp_path / "e.csv").write_text("a,b\n")
    with pytest.raises(ValueError, match="no rows"):
        ingest(spark, str(tmp_path / "e.csv"), str(tmp_path / "raw"))


def test_output_protection(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    protect_outputs(spark, [a, b])
    with pytest.raises(ValueError, match="share"):
        protect_outputs(spark, [a, a + "/"])
    with pytest.raises(ValueError, match="input"):
        protect_outputs(spark, [a], [a])
    write_json(spark, {"x": (1, {2})}, a)
    assert read_json(spark, a) == {"x": [1, [2]]}
    with pytest.raises(FileExistsError):
        protect_outputs(spark, [a])
    protect_outputs(spark, [a], overwrite=True)


def test_preparation_flow(spark, tmp_path, dirty):
    source = str(tmp_path / "s.parquet")
    write_table(dirty, source)
    rules = ValidationRules(("company_id",), "ai_adoption_level", ("High",))
    done = prepare_path(spark, source, str(tmp_path / "raw"), str(tmp_path / "c.parquet"), rules, SPEC)
    assert done.raw_report.rows == 3 and done.cleaned_report.rows == 1
    assert done.cleaning.empty_rows_removed == 1 and done.cleaning.duplicate_rows_removed == 1
    assert prepare_table(dirty, rules, SPEC).count() == 1
    with pytest.raises(ValueError, match="replace its source"):
        clean_path(spark, source, source, SPEC)


# --- strict scoring input ---------------------------------------------------
STRICT = StrictSpec(
    required_columns=("company_id", "size", "kind"), numeric_columns=("size",), text_columns=("kind",),
    nonnegative_columns=("size",), target_column="status", key_column="company_id", max_rows=100, max_columns=9,
)


def test_strict_input(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("Size,Kind,Status,note\n1, a ,x,7\n2.5,,y,8\n", encoding="utf-8")
    df, warnings = read_strict_csv(spark, str(path), STRICT)
    assert as_set(df.select("company_id", "size", "kind", "note")) == [
        ("UPLOAD-00001", 1.0, "a", 7), ("UPLOAD-00002", 2.5, None, 8)
    ]
    assert len(warnings) == 3 and "status" not in df.columns


def test_strict_violations(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("company_id,size,kind\nA,-1,x\nB,abc,x\n,,\nC,inf,x\n", encoding="utf-8")
    with pytest.raises(StrictInputError) as error:
        read_strict_csv(spark, str(path), STRICT)
    text = str(error.value)
    for part in ("negative size at lines [\"2", "not_a_number size at lines [\"3", "empty_row  at lines ['4'", "infinite size at lines [\"5"):
        assert part in text
    many = spark.range(100).select("id", F.lit("bad").alias("size"))
    assert violations(many, STRICT, "id").count() == 5
    assert violations(many, STRICT, "id", every=True).count() == 100


def test_strict_limits(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text("company_id,kind\nA,x\n", encoding="utf-8")
    with pytest.raises(StrictInputError, match="size"):
        read_strict_csv(spark, str(path), STRICT)
    with pytest.raises(StrictInputError, match="larger"):
        read_strict_csv(spark, str(path), StrictSpec(max_bytes=3))
    with pytest.raises(StrictInputError, match="blank"):
        checked_header(["a", "%"])
    with pytest.raises(StrictInputError, match="several"):
        checked_header(["a b", "A_b"])
    with pytest.raises(StrictInputError, match="limit"):
        checked_header(["a", "b"], 1)
    assert input_template(spark, ["b", "a"]).columns == ["b", "a"]
