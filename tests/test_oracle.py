"""Every registered query against its SQL counterpart in an independent engine."""

import os

import comparing
import pytest

import __spark_entry__ as entry_point
from cofre.registry import oracle, queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = queries.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = comparing.connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    got = comparing.spark_rows(QUERIES[name](spark, FOLDER))
    wanted = comparing.oracle_rows(duck, ORACLE[name])
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1])
    assert got[1] == wanted[1]


def test_entry_gives_months(spark):
    assert entry_point.entry(spark).columns[:3] == ["ano", "mes", "nome_mes"]
