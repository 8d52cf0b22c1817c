import os

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies int, cell string, row string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names operators use themselves."""

    def make(rows):
        full = [(i, t, lang, source, None if t is None else len(t), 1, "c", "r") for i, t, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def sf():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no driver tables here")
    return path


EDGE = [
    (1, None, None, None), (2, "", "en", "s"), (3, " \t\n", "en", "s"), (4, "one", "en", None), (4, "one", "en", None), (None, "no id here at all", "en", "s"),
    (5, "word " * 3000, "de", "s"), (6, "long " + "x" * 100_000, "en", "t"), (7, "éİ 😀 \x85 mixed", "fr", "t"),
]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGE)


@pytest.fixture(scope="session")
def empty_docs(make_docs):
    return make_docs([])
