"""Every key over the driver's tables against its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import differences, duck

from tallyroom.oracle import oracle_sql
from tallyroom.registry import queries
from tallyroom.sources.tables import TABLES

SF_DIR = "/root/testdata/sf0.01"
QUERIES, ORACLE = queries(), oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    return duck({t: f"{SF_DIR}/{t}.parquet" for t in TABLES})


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", QUERIES)
def test_matches_oracle(spark, con, key):
    assert not differences(QUERIES[key](spark, SF_DIR), con, ORACLE[key])


def test_no_key_is_empty(spark, con):
    empty = [k for k, sql in ORACLE.items() if not con.execute(sql).fetchone()]
    assert not empty


def test_entry(spark):
    import __spark_entry__ as contract

    assert set(contract.entry(spark).columns) == {"tariff", "total_users", "avg_total_cost"}
