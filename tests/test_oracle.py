"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), plus the weaker row check for queries without SQL."""

import pytest

from conftest import SF_ORACLE
from oracle import compare, duck
from tidemark.plans.catalog import load_all

REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(REG))
def test_query_matches_oracle(spark, con, name):
    r = REG[name]
    df = r.fn(spark, SF_ORACLE)
    if r.sql is None:
        assert df.count() >= 0
        return
    problems = compare(df, con, r.sql)
    assert not problems, problems


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["src_file_date", "o_orderstatus", "n_rows", "total_enrollment", "n_matched"]


def test_registry_contract():
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80
