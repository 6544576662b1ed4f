"""Positions within whole documents without a window over a whole document's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def document_order(rows: DataFrame, document: str, page: str, order: list[Column | str], name: str = "document_order") -> DataFrame:
    """rows with a 0-based position in their document: the place on the page plus the rows of earlier pages (prefix sums over one row a page)."""
    inner = Window.partitionBy(document, page).orderBy(*order)
    counts = rows.groupBy(document, page).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(document).orderBy(page).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(document, page, F.coalesce(before, F.lit(0)).alias("_before"))
    placed = rows.withColumn("_inner", F.row_number().over(inner) - 1).join(counts, [document, page])
    return placed.withColumn(name, (F.col("_before") + F.col("_inner")).cast("long")).drop("_before", "_inner")


def linked(rows: DataFrame, document: str, page: str, order: list[Column | str], value: str) -> DataFrame:
    """rows with previous_<value> and next_<value> along their document: neighbours on the page, at its ends those of the pages before and after."""
    inner = Window.partitionBy(document, page).orderBy(*order)
    marked = rows.withColumn("_p", F.lag(value).over(inner)).withColumn("_n", F.lead(value).over(inner)).withColumn("_i", F.row_number().over(inner))
    ends = marked.groupBy(document, page).agg(F.min_by(value, "_i").alias("_first"), F.max_by(value, "_i").alias("_last"))
    outer = Window.partitionBy(document).orderBy(page)  # one row a page
    ends = ends.select(document, page, F.lag("_last").over(outer).alias("_before"), F.lead("_first").over(outer).alias("_after"))
    both = marked.join(ends, [document, page])
    return both.withColumn(f"previous_{value}", F.coalesce("_p", "_before")).withColumn(f"next_{value}", F.coalesce("_n", "_after")).drop("_p", "_n", "_i", "_before", "_after")
