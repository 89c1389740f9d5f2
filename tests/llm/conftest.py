import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, body string, place long, "
    "key long, row string, w string, t string, fp long, score double, part int, spans string, "
    "quality_score double, bucket int, cell long, `dotted.name` string"
)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    letters = "abcdefghijklmnoprstuvé"
    return " ".join(
        "".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(words)
    )


def rows_of(pairs):
    """Documents with every other column of the clashing schema filled or null."""
    out = []
    for i, (doc_id, text) in enumerate(pairs):
        lang, source = (("en", "s0"), ("de", None), (None, "s1"))[i % 3]
        n = None if text is None else len(text)
        out.append((doc_id, text, lang, source, n, "b", 1, 2, "r", "w", "t", 3, 0.5, 4, "s", 0.1, 5, 6, "d"))
    return out


EDGES = [
    (1, prose(1, 120)),
    (1, prose(1, 120)),  # a repeated row
    (2, prose(1, 120)),  # an exact copy
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (None, prose(2, 60)),
    (None, None),
    (7, "la la la la la la la la la la la la la la la la la la la la la la la la la la"),
    (8, prose(3, 30_000)),  # very long
    (9, "x" * 70_000),
    (10, prose(4, 80) + "\n" + prose(5, 40)),
    (11, prose(6, 20) + "\n" + prose(5, 40) + "\nLicensed under the MIT License."),
    (12, "naïve ☃ ①▁x ÀÉ\n\n| a | b |"),
    (2**40, prose(4, 81)),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(rows_of(EDGES), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 13)] + [(1, 0, 1), (None, 1, 0), (6, None, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def make_docs(spark, pairs):
    return spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in pairs],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
