"""Every registered query vs its DuckDB oracle (rows-only when it has none), at sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
#: Tests of the training-data queries stand in tests/llm.
NAMES = sorted(n for n in E.queries() if n not in E.LLM_QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    r = compare(spark, con, name, SF)
    if r.get("oracle", True) is None:
        assert r["rows"] > 0 and not r["nan"], r
    else:
        assert r["cols"], r
        assert r["values"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 27
