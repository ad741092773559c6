import pytest

from llm.cases import ODD

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with the columns of ``documents`` and some that clash with names used inside."""
    def make(rows):
        full = [(i, t, None if i == 5 else "en", "s", None if t is None else len(t), 1, "x") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA + ", bucket int, score string")
    return make


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD)
