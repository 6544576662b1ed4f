import os

import pytest

from foliant.llm import queries
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    oracle.view(connection)
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    assert oracle.differing(spark, duck, queries.QUERIES[name], queries.SQL[name]) == ([], [])


@pytest.mark.parametrize("name", ["p1_found", "p2_groups", "p4_found", "p8_containers", "p9_found"])
def test_results_do_not_depend_on_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(str, queries.QUERIES[name](spark, oracle.FOLDER).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows[0] == rows[1]
