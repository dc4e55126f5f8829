import pytest

from retailmarts.llm.common import Scratch, prepare
from tests.conftest import spark as spark  # noqa: F401

DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(autouse=True)
def prepared(spark):  # noqa: F811
    prepare(spark)


@pytest.fixture
def scratch(spark):  # noqa: F811
    return Scratch(spark, "test")


@pytest.fixture
def documents(spark):  # noqa: F811
    """A documents table from (doc_id, text, source) rows, with columns that could clash with results."""

    def table(rows):
        full = [
            (i, t, "xx", s, None if t is None else len(t), 1, 2, "x", "y", 3.0, 4)
            for i, t, s in rows
        ]
        return spark.createDataFrame(
            full, DOCUMENT + ", row BIGINT, n BIGINT, kept STRING, size STRING, score DOUBLE, chunk BIGINT"
        )

    return table
