import random

import pytest

from starmart.llm.common import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _shipped(spark):
    ship_package(spark)


@pytest.fixture
def make_docs(spark):
    def make(texts, first=0, **columns):
        rows = [(first + i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, DOCS)
    return make


@pytest.fixture
def prose():
    def make(seed, n=80, vocabulary=400):
        g = random.Random(seed)
        return " ".join(f"w{g.randrange(vocabulary)}" for _ in range(n))
    return make
