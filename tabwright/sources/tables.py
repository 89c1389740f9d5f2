"""CSV, JSON and Parquet tables.

Missing tokens and NaN become NULL here, so every operator downstream can rely
on missing meaning NULL.
"""

from __future__ import annotations

import functools
import json
import operator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import NA_TOKENS, formula_safe, to_number
from tabwright.functions.dates import DEFAULT_DATE_FORMATS, parse_timestamp
from tabwright.functions.text import strip_text
from tabwright.operators.schema import nulls_only, quoted
from tabwright.sources.rawbytes import first_and_later_parts

FORMATS = ("csv", "json", "parquet")
# Values of a boolean CSV column.
TRUE_WORDS = ("True", "TRUE", "true")
FALSE_WORDS = ("False", "FALSE", "false")
INTEGER_PATTERN = r"^[+-]?\d+$"
ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table_format(path: str) -> str:
    """Format named by the path's suffix, ignoring case."""
    suffix = str(path).rstrip("/").rpartition("/")[2].rpartition(".")[2].lower()
    if suffix not in FORMATS:
        raise ValueError(f"cannot tell the table format of {path!r}; known: {list(FORMATS)}")
    return suffix


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    *,
    fmt: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Read a table; the format follows the suffix unless ``fmt`` is given.

    CSV without a schema is typed by one aggregate over the whole file. Spark splits
    large CSV files between tasks; ``multiline`` reads each file in one task, which a
    quoted value with a line break needs. Such values and records with more cells than
    the header raise an error. JSON is one record per line, or a document (an array
    of records or one object), told apart by the first line; malformed JSON raises.
    """
    fmt = fmt or table_format(path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if fmt == "csv":
        return read_csv(spark, path, schema, multiline=multiline)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "json":
        return nulls_only(
            reader.json(str(path), mode="FAILFAST", multiLine=multiline or is_json_document(spark, path))
        )
    if fmt == "parquet":
        return nulls_only(reader.parquet(str(path)))
    raise ValueError(f"unknown table format {fmt!r}; known: {list(FORMATS)}")


def is_json_document(spark, path) -> bool:
    """True when the first line with content is not a JSON object by itself."""
    first = spark.read.text(str(path)).filter(F.trim("value") != "").head()
    if first is None:
        return False
    try:
        return not isinstance(json.loads(first[0]), dict)
    except ValueError:
        return True


CSV = {"quote": '"', "escape": '"', "inferSchema": False}
#: Column that holds a record whose number of cells differs from the header's.
ODD_RECORD = "odd_record_"
END_MARK = "\u0002end\u0003"


def csv_records(spark, path, *, multiline=False) -> DataFrame:
    """All cells as text, and in ``ODD_RECORD`` each record with too few or too many of them.

    Every file must have the same header; of a large file copied in parts, the first part has
    it. Repeated and blank headers, which Spark renames, are taken by position.
    """
    path, others = first_and_later_parts(spark, path)
    names = spark.read.csv(path, header=True, multiLine=multiline, **CSV).columns
    head = spark.read.csv(path, header=False, multiLine=multiline, **CSV).head()
    if len(names) == 1:
        multiline = True  # a broken value cannot be told from two whole ones
    fields = [T.StructField(c, T.StringType()) for c in (*names, ODD_RECORD)]
    # all cells are parsed in every plan, since a pruned record never looks odd
    reader = (
        spark.read.schema(T.StructType(fields))
        .option("columnPruning", False)
        .options(multiLine=multiline, columnNameOfCorruptRecord=ODD_RECORD, mode="PERMISSIVE")
    )
    records = reader.csv(path, header=True, enforceSchema=head is None or list(head) != names, **CSV)
    if others:  # the later parts of one large file have no header
        records = records.unionByName(reader.csv(others, header=False, **CSV))
    return records


def surplus_cells(record, columns: int):
    """True for a record with more than ``columns`` cells.

    A mark is added as a last cell; in a longer record it lies beyond those looked at.
    """
    wide = ", ".join(f"c{i} string" for i in range(columns + 2))
    marked = F.concat(record, F.lit("," + END_MARK))
    cells = F.from_csv(marked, wide, {"quote": '"', "escape": '"'})
    seen = [cells[f"c{i}"].eqNullSafe(F.lit(END_MARK)) for i in range(columns + 1)]
    return record.isNotNull() & ~functools.reduce(operator.or_, seen)


def broken_line(record):
    """True for a record that ends inside a quoted value."""
    return record.isNotNull() & (F.length(F.regexp_replace(record, '[^"]', "")) % 2 == 1)


def csv_ragged_counts(spark, path, *, multiline=False) -> DataFrame:
    """One row: records, records with too few cells and with too many."""
    records = csv_records(spark, path, multiline=multiline)
    odd, width = F.col(ODD_RECORD), len(records.columns) - 1
    long = surplus_cells(odd, width)
    # Spark refuses plans that read the odd records alone, so the first cell is read too
    text = F.concat_ws(",", odd, quoted(records.columns[0]))
    return records.select(odd.isNotNull().alias("odd"), long.alias("long"), text.alias("text")).agg(
        F.count_if(F.length("text") >= 0).alias("records"),
        F.count_if(F.col("odd") & ~F.col("long")).alias("short_records"),
        F.count_if("long").alias("long_records"),
    )


def whole_csv(spark, path, *, multiline=False, ragged="error") -> DataFrame:
    """All cells as text; short rows are padded.

    A record with more cells than the header raises, or is left out with
    ``ragged="drop"`` (``csv_ragged_counts`` tells how many there are). A quoted value
    with a line break raises unless ``multiline``.
    """
    if ragged not in ("error", "drop"):
        raise ValueError("ragged records are an 'error', or 'drop' leaves them out")
    records = csv_records(spark, path, multiline=multiline)
    names = [c for c in records.columns if c != ODD_RECORD]
    if not names:
        raise ValueError(f"{path} holds no header")
    odd = F.col(ODD_RECORD)
    long = surplus_cells(odd, len(names))
    start = F.substring(F.concat_ws(" ", odd, quoted(names[0])), 1, 200)
    whole = F.when(odd.isNull(), True)
    if not multiline and len(names) > 1:
        reason = F.concat(F.lit("a quoted value holds a line break; read with multiline=True: "), start)
        whole = whole.when(broken_line(odd), F.raise_error(reason).cast("boolean"))
    if ragged == "error":
        reason = F.concat(F.lit(f"a record has more than {len(names)} cells: "), start)
        whole = whole.when(long, F.raise_error(reason).cast("boolean"))
    else:
        whole = whole.when(long, False)
    return records.filter(whole.otherwise(True)).select(*map(quoted, names))


def raw_csv(spark, path, *, multiline=False, ragged="error") -> DataFrame:
    """``whole_csv`` with missing tokens as NULL."""
    text = whole_csv(spark, path, multiline=multiline, ragged=ragged)
    return text.select(
        *[F.when(~quoted(c).isin(list(NA_TOKENS)), quoted(c)).alias(c) for c in text.columns]
    )


def read_csv(spark, path, schema=None, *, multiline=False) -> DataFrame:
    text = raw_csv(spark, path, multiline=multiline)
    kinds = {f.name: f.dataType for f in schema.fields} if schema else infer_types(text)
    return text.select(*[typed(quoted(c), kinds.get(c, T.StringType())).alias(c) for c in text.columns])


def infer_types(text: DataFrame) -> dict:
    """{column: type} from whether every present value is a whole number, a
    number or a boolean word; one aggregate, no sampling."""
    checks = []
    for i, c in enumerate(text.columns):
        value = quoted(c)
        checks += [
            F.count(value).alias(f"n{i}"),
            F.count_if(
                strip_text(value).rlike(INTEGER_PATTERN)
                & strip_text(value).try_cast("bigint").isNotNull()
            ).alias(f"i{i}"),
            F.count(to_number(value, T.StringType())).alias(f"d{i}"),
            F.count_if(value.isin(*TRUE_WORDS, *FALSE_WORDS)).alias(f"b{i}"),
        ]
    seen = text.agg(*checks).first() if checks else None
    kinds = {}
    for i, c in enumerate(text.columns):
        n = seen[f"n{i}"]
        if n == 0:
            kinds[c] = T.DoubleType()
        elif seen[f"i{i}"] == n:
            kinds[c] = T.LongType()
        elif seen[f"d{i}"] == n:
            kinds[c] = T.DoubleType()
        elif seen[f"b{i}"] == n:
            kinds[c] = T.BooleanType()
        else:
            kinds[c] = T.StringType()
    return kinds


def typed(c, dtype):
    """Text column as ``dtype``; what does not fit becomes NULL."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isin(*TRUE_WORDS), True).when(c.isin(*FALSE_WORDS), False)
    if isinstance(dtype, T.IntegralType):
        return strip_text(c).try_cast(dtype)
    if isinstance(dtype, T.NumericType):
        return to_number(c, T.StringType()).try_cast(dtype)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return parse_timestamp(c, T.StringType(), DEFAULT_DATE_FORMATS).try_cast(dtype)
    return c.try_cast(dtype)


def write_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str | None = None,
    overwrite: bool = False,
    partition_by=(),
    allowed=FORMATS,
) -> None:
    """Write a table in the format of the suffix; JSON is one record per line.

    Text keeps its own spaces and quotes; timestamps are written in ISO form.
    """
    fmt = fmt or table_format(path)
    if fmt not in allowed:
        raise ValueError(f"output must be one of {list(allowed)}, not {fmt!r}")
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    writer = writer.option("timestampNTZFormat", ISO_TIMESTAMP)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.csv(
            str(path),
            header=True,
            quote='"',
            escape='"',
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            timestampFormat=ISO_TIMESTAMP,
        )
    elif fmt == "json":
        writer.json(
            str(path),
            ignoreNullFields=False,
            timestampFormat=ISO_TIMESTAMP,
        )
    else:
        writer.parquet(str(path))


def formula_safe_table(df: DataFrame) -> DataFrame:
    """Text columns guarded against being run as spreadsheet formulas."""
    return df.select(
        *[
            (
                formula_safe(quoted(f.name))
                if isinstance(f.dataType, T.StringType)
                else quoted(f.name)
            ).alias(f.name)
            for f in df.schema.fields
        ]
    )


def export_csv(df: DataFrame, path: str, *, overwrite=False) -> None:
    """CSV for spreadsheets."""
    write_table(formula_safe_table(df), path, fmt="csv", overwrite=overwrite)
