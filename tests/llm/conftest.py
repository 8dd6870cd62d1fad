"""Small awkward tables for the text operators."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns of other meaning under names that operators use inside.
CLASHES = ("kept", "keep_id", "group_size", "digest", "size", "target", "copies", "score", "doc", "mark",
           "span", "bucket", "component", "class_id", "near", "host", "path", "rank", "query_id")


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(name).alias(name) for name in CLASHES if name not in df.columns])


@pytest.fixture(scope="session")
def words():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdeghilmnorstu", k=rng.randint(2, 8))) for _ in range(400)]

    def some(n, seed):
        return " ".join(random.Random(seed).choices(vocabulary, k=n))

    return some


@pytest.fixture(scope="session")
def rows(words):
    """Nulls, empty and blank texts, copies, near copies, a long text, repeated rows."""
    base = words(120, 1)
    near = base.replace(base.split()[60], "changed", 1)
    out = [
        (1, base, "en", "b", 1), (2, base, "en", "b", 1), (3, near, "en", "a", 1),
        (4, base.replace(" ", "\n"), None, None, None), (5, None, "en", "a", 0), (6, "", "en", None, 0),
        (7, " \t\n", "de", "c", 3), (8, words(6000, 2), "en", "c", 9), (9, "two words", "en", "a", 1),
        (9, "two words", "en", "a", 1), (10, "two  words ", "en", "b", 1), (None, base, "en", "a", 1),
        (None, None, None, None, None), (11, "éß 漢字 𝒳 ñandú " * 9, "es", "é", 1), (12, "x" * 700, "en", "a", 1),
    ]
    out += [(100 + i, words(20 + 7 * i, 50 + i), "en", "abc"[i % 3], i) for i in range(30)]
    return out


@pytest.fixture
def docs(spark, rows):
    return with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(3)


@pytest.fixture
def no_docs(spark):
    return with_clashes(spark.createDataFrame([], SCHEMA))
