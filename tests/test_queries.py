"""Every registered query against its oracle, on the smallest corpus."""

import pytest

import __spark_entry__ as entry_module
from oracles import oracle_sql
from tests.oracle import differences, tables

QUERIES = entry_module._mail_queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return tables(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(name, spark, sf_dir, connection):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) == []


def test_entry(spark, sf_dir):
    rows = entry_module.entry(spark).collect()
    assert [row["rank"] for row in rows] == list(range(1, 21))
    assert rows[0].email == "p7@en.example.com"
    assert rows[0].pagerank == pytest.approx(0.007073274119, abs=1e-12)
