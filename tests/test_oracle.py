"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from hitloom.plans.oracle import ORACLE_SQL
from hitloom.plans.registry import QUERIES
from conftest import TESTDATA
from oracle_compare import connect, difference

@pytest.fixture(scope="module")
def duck():
    return connect(f"{TESTDATA}/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, duck, ORACLE_SQL[name]) is None


def test_every_query_has_sql_and_is_handed_out():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE_SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_one_row_of_key_figures(spark):
    df = contract.entry(spark)
    assert df.columns == ["total_requests", "unique_ips", "error_rate_pct", "avg_kb_per_req"]
    assert df.count() == 1


def test_known_figures(spark):
    """Figures at the middle scale that both engines gave when the queries were designed."""
    row = contract.queries()["kpi_summary"](spark, f"{TESTDATA}/sf0.01").first()
    assert tuple(row) == (9900, 150, 20.13, 48.41)
