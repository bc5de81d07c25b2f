"""Every registered query on the smallest driver tables: against its SQL, or for rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check_oracle import differences, duck

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in ORACLES])
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert differences(got, con.sql(ORACLES[name]).df()) is None


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in ORACLES])
def test_query_has_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_every_sql_has_a_query_and_entry_has_rows(spark):
    assert set(ORACLES) <= set(entry.queries())
    assert entry.entry(spark).count() == 25
