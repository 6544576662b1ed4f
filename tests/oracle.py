"""Comparing a query with its SQL over the smallest tables."""

from __future__ import annotations

import os

FOLDER = "/root/testdata/sf0.001"


def view(duck) -> None:
    duck.sql("set timezone = 'UTC'")
    for name in os.listdir(FOLDER):
        path = f"{FOLDER}/{name}" + ("/*.parquet" if os.path.isdir(f"{FOLDER}/{name}") else "")
        duck.sql(f"create view {name.split('.')[0]} as select * from '{path}'")


def plain(value):
    if value is None or value != value:
        return None
    return round(value, 9) if isinstance(value, float) else str(value)


def differing(spark, duck, query, sql):
    """Rows on one side only, and the column names of both."""
    ours = query(spark, FOLDER)
    names = sorted(ours.columns)
    theirs = duck.sql(sql)
    if sorted(theirs.columns) != names:
        return names, sorted(theirs.columns)
    a = sorted(str([plain(r[n]) for n in names]) for r in ours.collect())
    order = [theirs.columns.index(n) for n in names]
    b = sorted(str([plain(r[i]) for i in order]) for r in theirs.fetchall())
    return ([], []) if a == b else ([x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3] or ["repeated rows"])
