"""Every query with an oracle gives the same names and values in both engines."""

import pytest

import __spark_entry__ as entry_file
from tallymark.plans.registry import ALL
from tests.compare import duck, oracle_rows, spark_rows

QUERIES, ORACLE = entry_file.queries(), entry_file.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLE) & set(ALL)))
def test_same_result(spark, sf_dir, con, name):
    names, got = spark_rows(QUERIES[name](spark, sf_dir))
    expected_names, expected = oracle_rows(con, ORACLE[name])
    assert names == expected_names
    assert got == expected
    assert got


@pytest.mark.parametrize("name", sorted(set(ALL) - set(ORACLE)))
def test_rows_only(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).limit(1).count() == 1


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
