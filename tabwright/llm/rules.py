"""Quality rules whose thresholds come from quantile sketches per language and source.

Everything here is DataFrame functions. A value that several expressions need is put
through a one-element array and ``explode``, which computes it once per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.session import cut_lineage

from .common import SPACE, own_columns

#: Fixed value: the same characters as ``SPACE``, for trimming.
BLANKS = " \t\n\r\x0b\x0c"
WINDOW = 8
#: A bucket holds one value up to here, then 32 buckets share each doubling.
EXACT = 64


@dataclass(frozen=True)
class Rule:
    """A measure in whole numbers and how far beyond the quartiles it may lie.

    The upper fence is q75 + spread * (q75 - q25) + slack, the lower one (if ``both``) the
    same below q25; ``slack`` keeps a group of near-equal values from losing its rest.
    """

    name: str
    expr: str
    slack: int
    both: bool = False


RULES = (
    Rule("symbols", "1000 * n_symbols div greatest(word_chars, 1)", 30),
    Rule("capitals", "1000 * n_upper div greatest(word_chars, 1)", 150),
    Rule("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 200),
    Rule("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 100),
    Rule("word_length", "100 * word_chars div greatest(n_words, 1)", 150, both=True),
)


@dataclass(frozen=True)
class RuleSpec:
    spread: int = 3
    #: Groups below this many documents use the merged sketch of their language, or of all.
    least_group: int = 200


def once(df: DataFrame, column, name: str) -> DataFrame:
    return df.select("*", F.explode(F.array(column)).alias(name))


def with_counts(docs: DataFrame) -> DataFrame:
    """``row`` (all own columns as a struct), ``lang``, ``source`` and the counts of each text.

    A null text has no words; null languages and sources form groups of their own.
    """
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*own_columns(docs)).alias("row"))
    rows = rows.select(
        "row", F.col("row.lang").alias("lang"), F.col("row.source").alias("source"), text.alias("t")
    )
    trimmed = F.btrim("t", F.lit(BLANKS))
    rows = once(
        rows,
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+")),
        "w",
    )
    rows = once(rows, F.transform("w", lambda x: F.xxhash64(x)), "wh")
    windows = F.when(
        F.size("wh") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("wh") - WINDOW),
            lambda i: F.xxhash64(*(F.get("wh", i + k) for k in range(WINDOW))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = once(rows, windows, "h")
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = once(rows, lines, "lines")
    joined = F.array_join("w", "")
    return rows.select(
        "row",
        "lang",
        "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("h")) == F.size("h"), F.lit(0))
        .otherwise(_covered("h"))
        .cast("long")
        .alias("n_repeat_words"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
    )


def _covered(hashes: str):
    """Words covered by windows whose hash occurs twice or more, each word once."""
    paired = F.array_sort(
        F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    )

    def repeated_starts(s):
        same = lambda a, b: F.get(s, a)["x"].eqNullSafe(F.get(s, b)["x"])
        return F.array_sort(
            F.transform(
                F.filter(s, lambda v, k: ((k > 0) & same(k, k - 1)) | same(k, k + 1)),
                lambda v: v["i"],
            )
        )

    def width(starts):
        steps = F.transform(
            starts,
            lambda v, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - v, F.lit(WINDOW))
            ),
        )
        return F.aggregate(steps, F.lit(0), lambda a, v: a + v)

    starts = F.transform(F.array(paired), repeated_starts)
    return F.transform(starts, width)[0]


def bucket(value: str) -> str:
    """SQL of a value's sketch bucket: exact below 64, then within 1/32."""
    up = f"(length(bin({value})) - 6)"
    return (
        f"CASE WHEN {value} < {EXACT} THEN {value} "
        f"ELSE {up} * 32 + cast(floor({value} / power(2, {up})) AS bigint) END"
    )


def bucket_low(b: str) -> str:
    """SQL of the least value of a bucket."""
    up = f"(cast(floor({b} / 32) AS bigint) - 1)"
    return f"CASE WHEN {b} < {EXACT} THEN {b} ELSE ({b} - {up} * 32) * cast(power(2, {up}) AS bigint) END"


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, rule, bucket, n): a mergeable quantile sketch per group and rule.

    A sketch is its bucket counts, so tasks combine theirs before the shuffle and two
    sketches merge by addition; the order of rows changes nothing.
    """
    pairs = ", ".join(f"'{r.name}', cast({r.expr} AS bigint)" for r in RULES)
    return (
        counts.filter("not base_failed")
        .selectExpr("lang", "source", f"stack({len(RULES)}, {pairs}) AS (rule, v)")
        .selectExpr("lang", "source", "rule", f"{bucket('v')} AS bucket")
        .groupBy("lang", "source", "rule", "bucket")
        .agg(F.count("*").alias("n"))
    )


def fences(sketch: DataFrame, spec: RuleSpec = RuleSpec()) -> DataFrame:
    """One row per (lang, source): ``<rule>_high`` and, where used, ``<rule>_low``."""
    none = F.lit(None).cast("string")
    levels = (
        sketch.select(F.lit(2).alias("level"), "*")
        .union(sketch.select(F.lit(1), "lang", none, "rule", "bucket", "n"))
        .union(sketch.select(F.lit(0), none, none, "rule", "bucket", "n"))
        .groupBy("level", "lang", "source", "rule", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    own = Window.partitionBy("level", "lang", "source", "rule")
    ranked = levels.select(
        "*", F.sum("n").over(own.orderBy("bucket")).alias("cum"), F.sum("n").over(own).alias("total")
    )
    quartiles = (
        ranked.groupBy("level", "lang", "source", "rule")
        .agg(
            F.max("total").alias("total"),
            *(
                F.min(F.expr(f"CASE WHEN cum * 4 >= total * {k} THEN {bucket_low('bucket')} END")).alias(f"q{k}")
                for k in (1, 3)
            ),
        )
        .withColumn("wide", spec.spread * (F.col("q3") - F.col("q1")))
    )
    fence = lambda r, sign: F.max(
        F.when(F.col("rule") == r.name, F.col("q3") + F.col("wide") + r.slack)
        if sign > 0
        else F.when(F.col("rule") == r.name, F.col("q1") - F.col("wide") - r.slack)
    )
    by_level = quartiles.groupBy("level", "lang", "source").agg(
        F.max("total").alias("total"),
        *(fence(r, 1).alias(f"{r.name}_high") for r in RULES),
        *(fence(r, -1).alias(f"{r.name}_low") for r in RULES if r.both),
    )
    names = [c for c in by_level.columns if c.endswith(("_high", "_low"))]
    at = lambda n, alias: by_level.filter(F.col("level") == n).select(
        F.col("lang").alias(f"lang{n}"), F.col("source").alias(f"source{n}"), F.struct("total", *names).alias(alias)
    )
    own, language = at(2, "own"), at(1, "language")
    whole = by_level.filter("level = 0").select("total", *names).head() or [None] * (1 + len(names))
    whole = F.struct(*(F.lit(v).cast("bigint").alias(c) for c, v in zip(["total", *names], whole)))
    joined = own.join(language, F.col("lang2").eqNullSafe(F.col("lang1")))
    best = (
        F.when(F.col("own.total") >= spec.least_group, F.col("own"))
        .when(F.col("language.total") >= spec.least_group, F.col("language"))
        .otherwise(whole)
    )
    return joined.select(
        F.col("lang2").alias("fence_lang"), F.col("source2").alias("fence_source"), best.alias("best")
    ).select("fence_lang", "fence_source", *(F.col(f"best.{c}").alias(c) for c in names))


def judged(counts: DataFrame, fence_rows: DataFrame) -> DataFrame:
    """``counts`` with ``kept``: false for base failures, else inside every fence of its group.

    The fences are broadcast while they are few (a checked count), else joined by shuffle.
    """
    fence_rows = cut_lineage(fence_rows)
    if fence_rows.count() <= 100_000:
        fence_rows = F.broadcast(fence_rows)
    inside = F.lit(True)
    for r in RULES:
        value = F.expr(r.expr)
        inside = inside & (value <= F.col(f"{r.name}_high"))
        if r.both:
            inside = inside & (value >= F.col(f"{r.name}_low"))
    joined = counts.join(
        fence_rows,
        F.col("lang").eqNullSafe(F.col("fence_lang")) & F.col("source").eqNullSafe(F.col("fence_source")),
        "left",
    )
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))


def rule_report(docs: DataFrame, spec: RuleSpec = RuleSpec()) -> DataFrame:
    """One row per document: its counts, the base verdict and whether it is kept.

    Counts are taken once and written as a narrow table to the shared checkpoint folder,
    from which sketches and verdicts are read. Repeated rows are judged one by one.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    counts = with_counts(narrow)
    counts = cut_lineage(
        counts.select(F.col("row.doc_id").alias("doc_id"), *[c for c in counts.columns if c != "row"])
    )
    return judged(counts, fences(sketches(counts), spec)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def keep_by_rules(docs: DataFrame, spec: RuleSpec = RuleSpec()) -> DataFrame:
    """The documents that the rules keep, with their own columns alone.

    Counts are taken twice, for the sketches and for the verdicts, which spares a shuffle
    of the texts.
    """
    counts = with_counts(docs)
    sketch = cut_lineage(sketches(counts))
    return judged(counts, fences(sketch, spec)).filter("kept").select("row.*")
