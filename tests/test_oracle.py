"""Every query with an oracle: Spark result == DuckDB SQL on the same parquet tables (sf0.01)."""

from __future__ import annotations

import pytest
from conftest import SF01
from oracle_util import compare, duck, spark_pdf

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sp = spark_pdf(entry.queries()[name](spark, SF01))
    od = con.execute(ORACLE[name]).df()
    res = compare(sp, od)
    assert res["cols_match"], res
    assert res["rows_match"], res
    assert res["close"], res


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["id", "churn"]
    assert len(rows) > 0
    assert {r["churn"] for r in rows} <= {"yes", "no"}
