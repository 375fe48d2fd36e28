import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fixtures_llm import EDGE  # noqa: E402
from rostra.llm.common import prepare  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def edge(llm):
    """Awkward rows, with columns whose names operators use inside."""
    rows = [(i, t, "x", 1, 2, "y", 3) for i, t in EDGE]
    shape = "doc_id bigint, text string, id string, fp int, votes int, mark string, n_words int"
    return llm.createDataFrame(rows, shape)


@pytest.fixture(scope="session")
def nothing(llm):
    return llm.createDataFrame([], "doc_id bigint, text string")


@pytest.fixture(scope="session")
def labels(llm):
    rows = [(i, 1, i % 2) for i in range(1, 13)] + [(1, 0, None), (None, 1, 1)]
    return llm.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
