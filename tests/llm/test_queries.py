"""Every registered query with SQL against that SQL; the others give a row for each input row."""

import comparing
import duckdb
import pytest
from conftest import FOLDER

from cofre.llm import queries as registered

QUERIES, ORACLE = registered.queries(), registered.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    duck = comparing.connect(FOLDER)
    got, wanted = comparing.spark_rows(QUERIES[name](spark, FOLDER)), comparing.oracle_rows(duck, ORACLE[name])
    duck.close()
    assert got == wanted


def test_entry_registers_all():
    import __spark_entry__ as entry_point

    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize(("name", "table"), [("op4_language_id", "documents"), ("op6_html_extraction", "pages"), ("op10_toxicity", "documents"), ("op11_fill_in_middle", "documents")])
def test_one_row_for_each(spark, name, table):
    found = QUERIES[name](spark, FOLDER).toPandas()
    assert len(found) == duckdb.sql(f"select count(*) from '{FOLDER}/{table}.parquet'").fetchall()[0][0]
