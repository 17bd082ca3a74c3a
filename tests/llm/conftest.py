import os

import pytest

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def pytest_collection_modifyitems(items):
    for item in items:
        if "folder" in getattr(item, "fixturenames", ()) and not os.path.isdir(FOLDER):
            item.add_marker(pytest.mark.skip(reason="no test tables"))


@pytest.fixture(scope="session")
def folder():
    return FOLDER


def words(seed, n, pool=400):
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(pool)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, and columns that clash with results."""
    long_text = words(1, 60_000, 5000)
    rows = [
        (1, "plain words of a short text", "en", "a", 27),
        (1, "plain words of a short text", "en", "a", 27),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\r\n ", "fr", None, 5),
        (5, long_text, "en", "b", len(long_text)),
        (6, "Ünïcödé \U0001f600 words ąć x@y.z +1 (555) 123-4567", "de", "b", 40),
        (None, "a row without an id, but with some words in it", "en", "a", 40),
        (7, "12345 67890 !!! ###", "en", "c", 19),
        (8, "\u0001 control \u0000 characters\u0001", None, "c", 20),
    ]
    clash = ", score string, kept string, spans string, rate string, `offset` string, quality string, topic string, tokens string, node string, label string, block string"
    return spark.createDataFrame([(*r, *["x"] * 11) for r in rows], DOCS + clash)
