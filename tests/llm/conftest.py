import os

import pytest

SF = "/root/testdata/sf0.001"
LONG = "der die das und " * 20_000  # one very long text

#: Nulls in every column, empty and blank texts, repeated rows, ties, one very long text.
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "s", 10),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "s", 10),
    (2, None, None, None, None),
    (3, "", "en", None, 0),
    (4, " \t\n\x0b ", None, "s", 5),
    (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "s", 10),
    (None, None, None, None, None),
    (6, "one", "en", "s", 3),
    (7, "  two  spaces\n\n and<|endoftext|> marks here \U0001f600 ", "en", "s", 20),
    (8, LONG, "de", "s", len(LONG)),
    (9, "Ünïcode Wörter ÉÀ straße 12 345 don't I'll", "fr", "s", 30),
]
#: Extra columns under names that the operators use themselves.
CLASHING = ("words", "n_words", "score", "kept", "key", "fp", "id", "row", "label", "component_id", "n", "uid", "__kept", "__barrier", "h", "at", "__text_")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd_docs(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    return docs.selectExpr("*", *[f"{i} as `{c}`" for i, c in enumerate(CLASHING) if not c.startswith("__")])


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (8, 1, 0), (9, 1, 0), (7, 0, 1)], "doc_id bigint, quality int, toxic int"
    )


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def larger_sf():
    """For accuracy on held-out rows, which takes some hundred labels."""
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("LLM_TEST_SF", SF)
