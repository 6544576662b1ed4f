"""Column expressions over boxes: structs with x0, y0, x1 and y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def width(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x1"] - b["x0"])


def height(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["y1"] - b["y0"])


def x_overlap(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))


def y_overlap(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))


def share_of(a: Column, b: Column) -> Column:
    """The intersection as a share of a's area."""
    return x_overlap(a, b) * y_overlap(a, b) / F.greatest(F.lit(1e-9), width(a) * height(a))


def covers(block: Column, line: Column, ratio: float = 0.35) -> Column:
    """The line's centre lies in the block, or at least ``ratio`` of the line does."""
    cx, cy = (line["x0"] + line["x1"]) / 2, (line["y0"] + line["y1"]) / 2
    inside = cx.between(block["x0"], block["x1"]) & cy.between(block["y0"], block["y1"])
    return inside | (share_of(line, block) >= ratio)
