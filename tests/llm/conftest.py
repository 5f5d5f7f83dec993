import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside
EXTRA = "t1 size h words seed place node sig label quality part slot c_doc_id row key hash id".split()


def prose(seed, n, words=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    one, two = prose(1, 120), prose(2, 90)
    return [
        (1, one, "en", "a", 5),
        (2, one, "en", "a", 5),
        (2, one, "en", "a", 5),
        (3, two + " tail of its own", None, "b", 7),
        (3, two, "en", None, 7),
        (None, two, "en", "b", None),
        (None, None, None, None, None),
        (4, None, "de", "a", 0),
        (5, "", "de", "a", 0),
        (6, " \t\n ", "de", "a", 0),
        (7, "one two three", "fr", "c", 13),
        (-8, "one two three four five", "fr", "c", 13),
        (9, prose(3, 30_000, 90_000), "en", "c", 1),
        (10, "naïve “ß” 日本 " * 30, "xx", "", 1),
        (11, one[: len(one) // 2] + " and " + two, "en", "a", 5),
    ]


@pytest.fixture
def odd(spark, odd_rows):
    """The odd rows, with extra columns whose names clash with names inside operators."""
    df = spark.createDataFrame(odd_rows, SCHEMA)
    return df.selectExpr("*", *(f"cast(doc_id AS string) AS {name}" for name in EXTRA))


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
