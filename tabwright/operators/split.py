"""Exact, reproducible train/validation/test splits without sorting the table.

Every row gets ``md5(seed|keys)``; inside its class a row's split depends only
on where that hash ranks against two cut points. Ranking all rows would shuffle
and sort the table. Instead only the cut points are found:

1. count rows per (class, leading hash digits), a small aggregate;
2. find the digit group that holds each cut and rank just the hashes in it;
3. compare each row's hash with its class's two cut points, row-local, with a
   broadcast of at most ``max(20, sqrt(rows))`` classes; tables of more than
   ``BROADCAST_CLASSES`` classes are joined by a shuffle instead.

Quotas are exact for every class and membership depends on nothing but the seed
and the keys, whatever the partitioning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.operators.counts import as_text
from tabwright.operators.schema import quoted, require_columns
from tabwright.session import settle

SPLITS = ("train", "validation", "test")
REASONS = {
    "few_classes": "fewer than two classes in {target}; splitting without classes",
    "many_classes": "{target} looks continuous or has too many classes; splitting without classes",
    "small_class": "a class of {target} has fewer rows than there are splits; splitting without classes",
}
# Largest table of cut points that is broadcast, and copies of each class beyond it.
BROADCAST_CLASSES = 50_000
SALTS = 16
# Per-class figures of up to this many classes are added up on the driver.
FEW_ENOUGH = 1_000
# Hash digits counted first, and digits of an md5.
PREFIX = 3
HASH_LENGTH = 32
# Rows of one digit group that a single ranking task may get.
GROUP_ROWS = 4_000_000
# Identical rows one task writes when a group of copies spans a cut.
COPIES_PER_TASK = 1_000_000


@dataclass(frozen=True)
class SplitSpec:
    """``most_classes``: classes a target may have (None: ``class_limit`` of the rows).
    ``fallback``: what follows when classes cannot be used, ``random`` (split without
    classes, with a warning) or ``error``."""

    train: float = 0.70
    validation: float = 0.15
    test: float = 0.15
    seed: int = 42
    target_column: str | None = None
    stratify: bool = True
    key_columns: tuple = ()
    most_classes: int | None = None
    fallback: str = "random"

    def __post_init__(self):
        if self.fallback not in ("random", "error"):
            raise ValueError("the fallback of a split is 'random' or 'error'")
        if min(self.fractions) < 0:
            raise ValueError("split fractions must not be negative")
        if not math.isclose(sum(self.fractions), 1.0, rel_tol=1e-5, abs_tol=1e-8):
            raise ValueError("split fractions must sum to 1")
        if self.train <= 0:
            raise ValueError("the train fraction must be positive")

    @property
    def fractions(self):
        return (self.train, self.validation, self.test)

    @property
    def active(self):
        return sum(f > 0 for f in self.fractions)


@dataclass(frozen=True)
class SplitResult:
    """``frame`` is the input with a ``split`` column; ``quotas`` holds one row
    per class (one row in all when classes are not used). ``one_pass`` says that ``frame``
    reads every row once, without a shuffle."""

    frame: DataFrame
    quotas: DataFrame
    warning: str | None
    one_pass: bool = False


def with_quotas(counts: DataFrame, fractions, rows: str = "n") -> DataFrame:
    """Add ``train``, ``validation``, ``test``: largest-remainder shares of ``n``.

    Equal remainders go to the earlier split.
    """
    exact = [F.lit(float(f)) * F.col(rows) for f in fractions]
    whole = [F.floor(e).cast("bigint") for e in exact]
    part = [e - w for e, w in zip(exact, whole)]
    left = F.col(rows) - sum(whole[1:], whole[0])
    for i, name in enumerate(SPLITS):
        ahead = [
            ((part[j] > part[i]) if j > i else (part[j] >= part[i])).cast("int")
            for j in range(3)
            if j != i
        ]
        counts = counts.withColumn(
            name, whole[i] + F.when(ahead[0] + ahead[1] < left, 1).otherwise(0)
        )
    return counts


def class_limit(rows):
    """Most classes a target may have: ``max(20, floor(sqrt(rows)))``."""
    return F.greatest(F.lit(20), F.floor(F.sqrt(rows))).cast("bigint")


def feasibility(counts: DataFrame, splits: int) -> DataFrame:
    """One row saying whether classes can be used, from per-class counts ``n``."""
    base = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count("*").alias("classes"),
        F.coalesce(F.min("n"), F.lit(0)).cast("bigint").alias("smallest"),
    ).withColumn("class_limit", class_limit(F.col("rows")))
    reason = (
        F.when(F.col("classes") < 2, "few_classes")
        .when(F.col("classes") > F.col("class_limit"), "many_classes")
        .when(F.col("smallest") < splits, "small_class")
        .otherwise("")
    )
    return base.withColumn("reason", reason).withColumn(
        "can_stratify", F.col("reason") == F.lit("")
    )


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(quoted(target).alias("class")).agg(F.count("*").alias("n"))


def row_hash(df: DataFrame, seed: int, key_columns=()):
    """md5 of ``seed|`` and the keys' texts; all columns when no keys are given.

    Each text is preceded by its length and a colon, a missing one is a dash, so
    different rows never have the same text to hash.
    """
    keys = list(key_columns) or df.columns
    fields = {f.name: f for f in df.schema.fields}
    texts = [as_text(fields[k]) for k in keys]
    marked = [
        F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    return F.md5(F.concat(F.lit(f"{seed}|"), *marked))


def _long_places(places: DataFrame) -> DataFrame:
    """(w_class, cut, place) from (class, place1, place2)."""
    return places.select(
        F.col("class").alias("w_class"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("cut"), F.col(f"place{i}").alias("place"))
                    for i in (1, 2)
                ]
            )
        ),
    ).filter("place > 0")


def _prefix_counts(hashed: DataFrame, length: int) -> DataFrame:
    return hashed.groupBy("class", F.substring("h", 1, length).alias("prefix")).agg(
        F.count("*").alias("n")
    )


def _sent(frame: DataFrame, classes: int) -> DataFrame:
    """A table of a few rows per class: broadcast, or joined by a shuffle when classes are many."""
    return F.broadcast(frame) if classes <= BROADCAST_CLASSES else frame


def _deepen(hashed: DataFrame, held: DataFrame, length: int, classes: int) -> DataFrame:
    """Replace each held prefix by the longer one that holds the same cut."""
    inside = hashed.join(_sent(held, classes), _inside_held()).groupBy(
        "class", "cut", F.substring("h", 1, length).alias("prefix")
    ).agg(F.count("*").alias("n"), F.first("offset").alias("offset"))
    upto = F.sum("n").over(Window.partitionBy("class", "cut").orderBy("prefix"))
    return (
        inside.withColumn("upto", upto)
        .filter("upto - n < offset and offset <= upto")
        .select(
            F.col("class").alias("held_class"),
            F.col("prefix").alias("held_prefix"),
            "cut",
            F.expr("offset - (upto - n)").alias("offset"),
            F.col("n").alias("size"),
        )
    )


def _inside_held():
    return F.col("class").eqNullSafe(F.col("held_class")) & F.col("h").startswith(
        F.col("held_prefix")
    )


def _cut_points(hashed: DataFrame, groups: DataFrame, places: DataFrame, classes: int):
    """(cut_class, h1, spare1, taken1, h2, spare2, taken2), one row per class.

    ``h1`` and ``h2`` are the hashes at the two cuts, ``taken`` counts the rows
    with that hash that belong before the cut and ``spare`` those after it. An
    empty ``h`` lies before all rows.
    """
    upto = F.sum("n").over(Window.partitionBy("class").orderBy("prefix"))
    held = (
        groups.withColumn("upto", upto)
        .join(
            _sent(_long_places(places), classes), F.col("class").eqNullSafe(F.col("w_class"))
        )
        .filter("upto - n < place and place <= upto")
        .select(
            F.col("class").alias("held_class"),
            F.col("prefix").alias("held_prefix"),
            "cut",
            F.expr("place - (upto - n)").alias("offset"),
            F.col("n").alias("size"),
        )
    )
    held = settle(held, classes)
    length = PREFIX
    while length < HASH_LENGTH:
        biggest = _largest(held, classes)
        if biggest <= GROUP_ROWS:
            break
        length = min(HASH_LENGTH, length + max(2, math.ceil(math.log(biggest / GROUP_ROWS, 16))))
        large = held.filter(F.col("size") > GROUP_ROWS)
        held = settle(
            held.filter(F.col("size") <= GROUP_ROWS).unionByName(_deepen(hashed, large, length, classes)),
            classes,
        )
        if _largest(held, classes) > biggest / 2:
            length = HASH_LENGTH  # copies: their shared hash is one counted row below

    inside = (
        hashed.join(_sent(held, classes), _inside_held())
        .groupBy("class", "cut", "h")
        .agg(F.count("*").alias("n"), F.first("offset").alias("offset"))
    )
    upto = F.sum("n").over(Window.partitionBy("class", "cut").orderBy("h"))
    found = (
        inside.withColumn("upto", upto)
        .filter("upto - n < offset and offset <= upto")
        .withColumn("spare", F.col("upto") - F.col("offset"))
        .withColumn("taken", F.col("n") - F.col("spare"))
    )

    def at(cut, field):
        return F.max(F.when(F.col("cut") == cut, F.col(field))).alias(f"{field}{cut}")

    both = found.groupBy("class").agg(
        *[at(cut, field) for cut in (1, 2) for field in ("h", "spare", "taken")]
    )
    table = (
        places.select(F.col("class").alias("cut_class"))
        .join(both, F.col("cut_class").eqNullSafe(F.col("class")), "left")
        .select(
            "cut_class",
            *[F.coalesce(F.col(f"h{i}"), F.lit("")).alias(f"h{i}") for i in (1, 2)],
            *[
                F.coalesce(F.col(f"{f}{i}"), F.lit(0)).alias(f"{f}{i}")
                for i in (1, 2)
                for f in ("spare", "taken")
            ],
        )
    )
    return settle(table, classes)


def _side(h, place=None):
    """Split of a row with hash ``h``; ``place`` orders rows sharing a cut hash."""
    first, second = h <= F.col("h1"), h <= F.col("h2")
    if place is not None:
        first = (h < F.col("h1")) | ((h == F.col("h1")) & (place < F.col("taken1")))
        second = (h < F.col("h2")) | ((h == F.col("h2")) & (place < F.col("taken2")))
    return F.when(first, "train").when(second, "validation").otherwise("test").alias("split")


def _is_tied(h):
    return ((h == F.col("h1")) & (F.col("spare1") > 0)) | (
        (h == F.col("h2")) & (F.col("spare2") > 0)
    )


def _largest(held: DataFrame, classes: int) -> int:
    sizes = held.select("size")
    if classes > FEW_ENOUGH:
        sizes = sizes.agg(F.max("size"))
    return max((r[0] or 0 for r in sizes.collect()), default=0)


def _has_ties(cuts: DataFrame) -> bool:
    return bool(cuts.filter("spare1 > 0 or spare2 > 0").take(1))


def _place_copies(tied: DataFrame, columns) -> DataFrame:
    """Split the rows that share the hash at a cut.

    The copies are counted first, so a group that holds a third of the table
    shrinks in the map tasks, and are written out again in bounded pieces. Should
    different rows share a hash, each is placed after the copies of those before it.
    """
    marks = ["cut_class", "h", "h1", "h2", "taken1", "taken2"]
    counted = tied.groupBy(*[quoted(c) for c in columns], *marks).agg(
        F.count("*").alias("copies")
    )
    earlier = (
        Window.partitionBy("cut_class", "h")
        .orderBy(*[quoted(c) for c in columns])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = counted.withColumn("before", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    pieces = counted.withColumn(
        "piece",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(copies - 1) div {COPIES_PER_TASK}"))),
    ).repartition("h", "piece")
    first = F.col("piece") * F.lit(COPIES_PER_TASK)
    last = F.least(first + COPIES_PER_TASK, F.col("copies")) - 1
    return pieces.withColumn("place", F.explode(F.sequence(first, last))).select(
        *[quoted(c) for c in columns], _side(F.col("h"), F.col("before") + F.col("place"))
    )


def _with_cuts(rows: DataFrame, class_value, cuts: DataFrame, classes: int) -> DataFrame:
    """Rows with the cut points of their class.

    Up to ``BROADCAST_CLASSES`` rows of cut points are broadcast. More are shuffled with the
    rows, each class in ``SALTS`` copies, so the rows of a hot class go to several tasks.
    """
    if classes <= BROADCAST_CLASSES:
        return rows.join(F.broadcast(cuts), class_value.eqNullSafe(F.col("cut_class")))
    copies = cuts.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    own = F.pmod(F.xxhash64("h"), F.lit(SALTS)) == F.col("salt")
    return rows.join(copies, class_value.eqNullSafe(F.col("cut_class")) & own).drop("salt")


def _assign(df, spec, class_value, key_columns, cuts, classes, ties) -> DataFrame:
    """Row-local comparison of each row's hash with its class's cut points."""
    columns = df.columns
    placed = _with_cuts(
        df.withColumn("h", row_hash(df, spec.seed, key_columns)), class_value, cuts, classes
    )
    plain = [quoted(c) for c in columns]
    if not ties:
        return placed.select(*plain, _side(F.col("h")))
    clear = placed.filter(~_is_tied(F.col("h"))).select(*plain, _side(F.col("h")))
    tied = placed.filter(_is_tied(F.col("h")))
    if not key_columns:
        return clear.unionByName(_place_copies(tied, columns))
    # Repeated user keys: the same search again inside each tied key, now by a
    # hash of the whole row, so a key that holds a third of the table is spread.
    group = F.md5(F.concat_ws("|", F.col("cut_class").cast("string"), F.col("h")))
    rows = tied.withColumn("tie_group", group).select(*plain, "tie_group")
    whole = F.col("taken1") + F.col("spare1")
    tie_places = cuts.select(
        "cut_class",
        F.inline(
            F.array(
                F.struct(
                    F.col("h1").alias("h"),
                    (F.col("spare1") > 0).alias("used"),
                    F.col("taken1").alias("place1"),
                    F.when(F.col("h1") == F.col("h2"), F.col("taken2")).otherwise(whole).alias("place2"),
                ),
                F.struct(
                    F.col("h2").alias("h"),
                    (F.col("spare2") > 0).alias("used"),
                    F.when(F.col("h1") == F.col("h2"), F.col("taken1")).otherwise(0).alias("place1"),
                    F.col("taken2").alias("place2"),
                ),
            )
        ),
    )
    tie_places = (
        tie_places.filter("used")
        .select(group.alias("class"), "place1", "place2")
        .dropDuplicates(["class"])
    )
    hashed = rows.select(
        F.col("tie_group").alias("class"), row_hash(df, spec.seed).alias("h")
    )
    inner_cuts = _cut_points(
        hashed, _prefix_counts(hashed, PREFIX), settle(tie_places, 2 * classes), 2 * classes
    )
    inner = _with_cuts(
        rows.withColumn("h", row_hash(df, spec.seed)), F.col("tie_group"), inner_cuts, 2 * classes
    )
    return (
        clear.unionByName(
            inner.filter(~_is_tied(F.col("h"))).select(*plain, _side(F.col("h")))
        ).unionByName(_place_copies(inner.filter(_is_tied(F.col("h"))), columns))
    )


# Names used while splitting; columns that have them are renamed meanwhile.
RESERVED = (
    "h", "h1", "h2", "spare1", "spare2", "taken1", "taken2",
    "cut_class", "tie_group", "copies", "piece", "place", "before", "salt",
)


def split_table(df: DataFrame, spec: SplitSpec, observed: DataFrame | None = None) -> SplitResult:
    """Add a ``split`` column with exact quotas per class.

    Three passes; the first two read keys and target only, and the table itself
    is never shuffled. Rows without a class value form a class of their own.
    ``observed`` is ``df`` with an observation; the result reads it if that takes one pass.
    """
    if "split" in df.columns:
        raise ValueError("the table already has a column named split")
    require_columns(df, spec.key_columns, "split keys")
    if set(RESERVED) & set(df.columns):
        return _split_renamed(df, spec, observed)
    warning = None
    target = spec.target_column if spec.stratify else None
    if target is not None:
        require_columns(df, [target], "the split target")

    def first_pass(class_value):
        hashed = df.select(
            class_value.alias("class"), row_hash(df, spec.seed, spec.key_columns).alias("h")
        )
        groups = _prefix_counts(hashed, PREFIX).persist()
        per_class = groups.groupBy("class").agg(F.sum("n").alias("n"))
        head = per_class.limit(FEW_ENOUGH + 1).toArrow()
        if head.num_rows <= FEW_ENOUGH:
            sizes = head.column("n").to_pylist()
            state = (sum(sizes), len(sizes), min(sizes, default=0))
            per_class = df.sparkSession.createDataFrame(head, schema=per_class.schema)
        else:
            state = tuple(per_class.agg(F.sum("n"), F.count("*"), F.min("n")).first())
        return hashed, groups, per_class, *state

    class_value = quoted(target) if target else F.lit("all rows")
    hashed, groups, per_class, rows, classes, smallest = first_pass(class_value)
    if target is not None:
        reason = no_classes_reason(rows, classes, smallest, spec.active, spec.most_classes)
        if reason and spec.fallback == "error":
            raise ValueError(REASONS[reason].format(target=target).partition(";")[0])
        if reason:
            warning = REASONS[reason].format(target=target)
            groups.unpersist()
            class_value = F.lit("all rows")
            hashed, groups, per_class, rows, classes, smallest = first_pass(class_value)
    if rows == 0:
        raise ValueError("there are no rows to split")

    quotas = settle(with_quotas(per_class, spec.fractions), classes)
    _check_sizes(quotas, spec, classes)
    places = quotas.select(
        "class", F.col("train").alias("place1"), F.expr("train + validation").alias("place2")
    )
    cuts = _cut_points(hashed, groups, places, classes)
    groups.unpersist()
    ties = _has_ties(cuts)
    one_pass = classes <= BROADCAST_CLASSES and not ties
    read = observed if one_pass and observed is not None else df
    frame = _assign(read, spec, class_value, spec.key_columns, cuts, classes, ties)
    return SplitResult(frame, quotas, warning, one_pass)


def _split_renamed(df: DataFrame, spec: SplitSpec, observed: DataFrame | None) -> SplitResult:
    held = {c: f"tw_{c}_held" for c in df.columns if c in RESERVED}
    inner = replace(
        spec,
        target_column=held.get(spec.target_column, spec.target_column),
        key_columns=tuple(held.get(c, c) for c in spec.key_columns),
    )
    observed = observed and observed.withColumnsRenamed(held)
    result = split_table(df.withColumnsRenamed(held), inner, observed)
    warning = result.warning
    if warning and spec.target_column in held:
        warning = warning.replace(held[spec.target_column], spec.target_column)
    back = {new: old for old, new in held.items()}
    return replace(result, frame=result.frame.withColumnsRenamed(back), warning=warning)


def no_classes_reason(rows: int, classes: int, smallest: int, splits: int, most=None) -> str:
    """Why classes cannot be used, or '' when they can."""
    if classes < 2:
        return "few_classes"
    if classes > (max(20, math.isqrt(rows)) if most is None else most):
        return "many_classes"
    return "small_class" if smallest < splits else ""


def _check_sizes(quotas: DataFrame, spec: SplitSpec, classes: int) -> None:
    names = ("n", *SPLITS)
    if classes <= FEW_ENOUGH:
        parts = quotas.collect()
        sizes = {s: sum(r[s] for r in parts) for s in names}
    else:
        sizes = quotas.agg(*[F.sum(s).alias(s) for s in names]).first()
    for name, fraction in zip(SPLITS, spec.fractions):
        if fraction > 0 and not sizes[name]:
            raise ValueError(f"the {name} split would be empty; use more rows or other fractions")
        if fraction == 0 and sizes[name]:
            raise RuntimeError(f"rows were assigned to the unused {name} split")
    if sum(sizes[s] for s in SPLITS) != sizes["n"]:
        raise RuntimeError("split sizes do not add up to the input")


def split_sizes(result: SplitResult) -> DataFrame:
    """(split, rows) from the quotas, without another pass over the table."""
    return result.quotas.agg(*[F.sum(s).alias(s) for s in SPLITS]).select(
        F.inline(
            F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("rows")) for s in SPLITS])
        )
    )
