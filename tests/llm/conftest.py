import random

import pytest

from ledgerlift.llm.common import prepared

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, t string, h long, s int, fp long, score string, __row string, __id long, __key long, __spans string, __words int, __lang string, __score double, found int, `a.b` string, row string"


def words(seed, n, vocabulary=400):
    picker = random.Random(seed)
    return " ".join(f"w{picker.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with every trouble: nulls, empty and long texts, ties, repeated rows, other columns with likely names."""
    extra = (1, "k", "t", 2, 3, 4, "x", "r", 5, 6, "s", 7, "l", 0.5, 8, "dotted", "whole")
    long = words(1, 6000)
    rows = [
        (1, words(2, 300), "aa", "a"),
        (2, words(2, 300), "aa", "b"),
        (3, words(2, 300) + " tail", "aa", None),
        (3, words(2, 300) + " tail", "aa", None),
        (4, None, "bb", "a"),
        (5, "", None, "a"),
        (None, words(3, 80), "bb", "b"),
        (None, None, None, None),
        (6, " \t\n", "bb", "c"),
        (7, long, "aa", "a"),
        (8, "A b", "bb", "b"),
        (8, "a  B", "bb", "b"),
        (9, words(4, 50), "aa", "b"),
        (10, words(5, 40) + ' password = "hunter2hunter2hunter" éé', "bb", "own/r1"),
    ]
    return [(d, t, lang, src, None if t is None else len(t), *extra) for d, t, lang, src in rows]


@pytest.fixture
def odd(spark, odd_rows):
    return prepared(spark).createDataFrame(odd_rows, SCHEMA)


@pytest.fixture
def nothing(spark):
    return prepared(spark).createDataFrame([], SCHEMA)
