"""Range joins as equi-joins on grid cells."""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, functions as F


def cell(x: Column, size: float) -> Column:
    return F.floor(x / size).cast("long")


def grid_join(a: DataFrame, b: DataFrame, radius: float, ax: str, ay: str, bx: str, by: str) -> DataFrame:
    """Pairs whose x and y differ by at most radius each; a filter for a disc may follow.

    `a` keeps its cell, `b` goes to the nine cells around its own: a hash join without a
    nested loop. Column names of both sides must differ.
    """
    near = F.array(*(F.lit(k) for k in (-1, 0, 1)))
    left = a.withColumns({"__cx": cell(F.col(ax), radius), "__cy": cell(F.col(ay), radius)})
    right = b.withColumn("__dx", F.explode(near)).withColumn("__dy", F.explode(near))
    right = right.withColumns({"__cx": cell(F.col(bx), radius) + F.col("__dx"), "__cy": cell(F.col(by), radius) + F.col("__dy")}).drop("__dx", "__dy")
    inside = (F.abs(F.col(ax) - F.col(bx)) <= radius) & (F.abs(F.col(ay) - F.col(by)) <= radius)
    return left.join(right, ["__cx", "__cy"]).where(inside).drop("__cx", "__cy")


def first_radius(points: DataFrame, radius: float, x: str, y: str, many: int = 4) -> float:
    """`radius`, or less where points stand close: where a point's own cell holds about `many` of them.

    For searches that double a radius until they are done: their answer doesn't depend on it.
    """
    at = points.groupBy(cell(F.col(x), radius).alias("cx"), cell(F.col(y), radius).alias("cy")).agg(F.count("*").cast("double").alias("n"))
    held, n = at.agg(F.sum(F.col("n") * F.col("n")), F.sum("n")).first()
    return radius * min(1.0, sqrt(many * n / held)) if n else radius


def covered_cells(x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> Column:
    """Array of (cx, cy) of all cells that the box of two points touches."""
    xs = F.sequence(cell(F.least(x0, x1), size), cell(F.greatest(x0, x1), size))
    ys = F.sequence(cell(F.least(y0, y1), size), cell(F.greatest(y0, y1), size))
    return F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def offsets(radius: int, disc: bool = True) -> list[tuple[int, int]]:
    return [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if not disc or i * i + j * j <= radius * radius]


def moves(radius: int, disc: bool = True) -> Column:
    """Constant array of the offsets of a structuring element."""
    return F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in offsets(radius, disc)))


def cells_within(metres: float, size: float) -> int:
    return max(1, ceil(metres / size))
