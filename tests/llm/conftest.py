"""Odd rows that every operator must take."""

import pytest

from millrace.llm.shared import ship

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{i % 977} the of{i % 13}" for i in range(60_000))
#: Columns with the names that operators use inside.
CLASHING = "row string, _row string, g int, fp long, key long, n_words long, kept string, host string, part int, page long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


@pytest.fixture(scope="session")
def corpus(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(corpus):
    """Nulls in any column, empty, blank and very long texts, ties and repeated rows, more columns."""
    other = ("r", "_", 1, 2, 3, 4, "k", "h", 5, 6)
    prose = " ".join(f"w{i}" for i in range(80))
    rows = [
        (1, None, "en", "a", 0, *other),
        (None, prose, None, None, None, *[None] * len(other)),
        (None, None, None, None, None, *[None] * len(other)),
        (2, "", "en", "a", 0, *other),
        (3, " \t\n\x0b ", "en", "b", 5, *other),
        (4, LONG, "en", "b", len(LONG), *other),
        (5, prose, "en", "a", 1, *other),
        (5, prose, "en", "a", 1, *other),
        (5, "another text of the same id " + prose, "en", "a", 1, *other),
        (6, "naïve ÉTÉ 日本語 😀 | # $ <b>", "fr", "c", 9, *other),
        (7, "one", "en", None, 3, *other),
        (8, "null byte \x00 and   space", "en", "c", 3, *other),
    ]
    return corpus.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(corpus):
    return corpus.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(corpus):
    return corpus.read.parquet(f"{SF_DIR}/documents.parquet")
