from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that the operators use for columns of their own.
    "id string, fp string, component_id string, size string, target string, score string, "
    "held_out string, start string, part string, found string, words string, "
)
OWN = (
    "__n", "__id", "__row", "__won", "__src", "__size", "__hash", "__taken", "__span", "__at",
    "__start", "__p", "__items", "__spans", "__n_words", "row", "won", "copies", "predicted", "rest",
)
SCHEMA += ", ".join(f"`{name}` string" for name in OWN)
CLASH = ("x",) * (11 + len(OWN))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, blank and long texts, ties, repeated rows, clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, "Alpha beta gamma delta", "en", "a"),
        (1, "Alpha beta gamma delta", "en", "a"),
        (2, "alpha BETA gamma delta", "en", "b"),
        (3, None, "en", "b"),
        (4, "", None, None),
        (5, " \n\t ", "fr", "b"),
        (6, long, "en", "a"),
        (7, "one", None, None),
        (None, "un deux trois quatre cinq", "fr", "c"),
        (None, None, None, None),
        (8, "12345 !!! ???", "fr", "c"),
        (9, "é" * 50 + " ß 中文 text", "fr", "c"),
    ]
    return spark.createDataFrame([(*r, 1, *CLASH) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, request):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    """Workers import the library from where the tests do."""
    from tillbook.llm.common import importable

    importable(lambda session: session)(spark)
