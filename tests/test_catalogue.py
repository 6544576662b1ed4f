import os

import pytest

from foliant.plans import catalogue
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    oracle.view(connection)
    return connection


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, duck, name):
    assert oracle.differing(spark, duck, catalogue.QUERIES[name], catalogue.SQL[name]) == ([], [])


@pytest.mark.parametrize("name", ["text_chunks", "reading_order", "merged_tables", "arbitration"])
def test_results_do_not_depend_on_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(str, catalogue.QUERIES[name](spark, oracle.FOLDER).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows[0] == rows[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
