"""Every registered query against its DuckDB oracle on the smallest test tables, and the
driver contract of ``__spark_entry__``."""

import importlib.util
import os

import pytest

from oracle import compare, duck

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


ENTRY = _entry()
KEYS = sorted(ENTRY.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract():
    q, o = ENTRY.queries(), ENTRY.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_entry_runs(spark):
    df = ENTRY.entry(spark)
    assert df.count() >= 0 and "renta_media" in df.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = ENTRY.queries()[key](spark, SF)
    sql = ENTRY.oracle_sql().get(key)
    if sql is None:
        assert df.count() >= 0
        return
    result = compare(df, con, sql)
    assert result["ok"], result
