"""Small awkward tables for the text operators."""

import random

import pytest

KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, word int, row string, _id string, key string"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_rows():
    """Nulls, empty and long texts, equal texts in many cases, near copies, shared passages, repeated rows."""
    rng = random.Random(5)
    passage, long = prose(rng, 60), prose(rng, 9000, 5000)
    base = prose(rng, 120)
    texts = [None, "", " \t\n", "one", "one two", "One TWO", "É é É", "é É é", base, base.upper(), base, long, long + " tail", prose(rng, 30) + " " + passage + " " + prose(rng, 20), passage,
             "x " * 50, "x " * 80, prose(rng, 300), "Released under the MIT License.\n" + prose(rng, 20), "zero\x00byte \x1f unit\x85sep em <|endoftext|> it's  two  spaces \n\n end", "ab" * 4000]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, prose(rng, rng.randrange(5, 90))) for i in range(40)]
    rows += [(200 + i, base) for i in range(25)]
    rows += [(3, "one"), (None, "no id"), (None, None), (None, base)]
    return [(i, t, None if (i or 0) % 3 else "en", "src0", len(t or ""), "extra", 1, None, "z", "k") for i, t in rows]


@pytest.fixture(scope="session")
def rows():
    return awkward_rows()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, KINDS).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], KINDS)
