import random

import pytest
from odd import ODD_TEXTS

SF = "/root/testdata/sf0.001"


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def documents(spark):
    """All documents of the smallest tables, on the driver."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture
def odd(spark):
    """Nulls, empty, blank, very long and repeated texts, ids missing or twice, and columns whose names clash."""
    rows = [(i, t, "de", 1, "x", True, 0.5, 7) for i, t in ODD_TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words long, spans string, kept boolean, "
                                       "score double, node long")


@pytest.fixture
def nothing(odd):
    return odd.limit(0)
