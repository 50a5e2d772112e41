"""Polygon algebra on sets of grid cells (label, cx, cy).

Areas are approximate: the error is of the order of the outline times the cell size.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from mercato.operators.components import connected_components
from mercato.operators.grid import cell, moves, offsets
from mercato.session import cut

KEYS = ["label", "cx", "cy"]


def of_points(points: DataFrame, size: float, label: str = "label", x: str = "xx", y: str = "yy") -> DataFrame:
    return points.select(F.col(label).alias("label"), cell(F.col(x), size).alias("cx"), cell(F.col(y), size).alias("cy")).distinct()


def dilate(cells: DataFrame, radius: int, disc: bool = True) -> DataFrame:
    c = cells.select(*KEYS, F.explode(moves(radius, disc)).alias("m"))
    return c.select("label", (F.col("cx") + F.col("m.i")).alias("cx"), (F.col("cy") + F.col("m.j")).alias("cy")).distinct()


def erode(cells: DataFrame, radius: int, disc: bool = True) -> DataFrame:
    """Cells all of whose neighbours are there: each cell votes for its neighbours, and full counts stay."""
    c = cells.select(*KEYS, F.explode(moves(radius, disc)).alias("m"))
    c = c.groupBy("label", (F.col("cx") + F.col("m.i")).alias("cx"), (F.col("cy") + F.col("m.j")).alias("cy")).count()
    return c.where(F.col("count") == len(offsets(radius, disc))).select(*KEYS)


def close(cells: DataFrame, grow: int, shrink: int | None = None, disc: bool = True) -> DataFrame:
    return erode(dilate(cells, grow, disc), grow if shrink is None else shrink, disc)


def union(*sets: DataFrame) -> DataFrame:
    out = sets[0].select(*KEYS)
    for s in sets[1:]:
        out = out.unionByName(s.select(*KEYS))
    return out.distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*KEYS).join(b.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi")


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select(*KEYS).join(b.select("cx", "cy").distinct(), ["cx", "cy"], "left_anti")


def area(cells: DataFrame, size: float) -> DataFrame:
    return cells.groupBy("label").agg((F.count("*") * size * size).alias("area"))


def _number(cx: Column, cy: Column) -> Column:
    """A cell as one number, ascending by column then row (cells within +-2^30)."""
    return (cx + F.lit(1 << 30)) * F.lit(1 << 31) + (cy + F.lit(1 << 30))


def parts(cells: DataFrame) -> DataFrame:
    """cells with part: the number of the smallest cell of the 4-connected part, per label."""
    node = F.xxhash64("label", "cx", "cy")
    a = cells.select(*KEYS, node.alias("src"))
    steps = a.select("label", "src", (F.col("cx") + 1).alias("cx"), "cy").unionByName(a.select("label", "src", "cx", (F.col("cy") + 1).alias("cy")))
    edges = steps.join(a.select(*KEYS, F.col("src").alias("dst")), KEYS).select("src", "dst")
    found = connected_components(edges)
    j = a.join(found.withColumnRenamed("node", "src"), "src", "left").withColumn("component", F.coalesce("component", "src"))
    low = j.groupBy("component").agg(F.min(_number(F.col("cx"), F.col("cy"))).alias("part"))
    return j.join(low, "component").select(*KEYS, "part")


def fill_holes(cells: DataFrame) -> DataFrame:
    """cells with the cells they enclose: parts of the complement that don't reach the box's rim."""
    box = cells.groupBy("label").agg(F.min("cx").alias("x0"), F.max("cx").alias("x1"), F.min("cy").alias("y0"), F.max("cy").alias("y1"))
    full = box.withColumn("cx", F.explode(F.sequence(F.col("x0") - 1, F.col("x1") + 1))).withColumn("cy", F.explode(F.sequence(F.col("y0") - 1, F.col("y1") + 1)))
    outside = full.join(cells.select(*KEYS), KEYS, "left_anti")
    p = parts(outside.select(*KEYS)).join(box, "label")
    rim = (F.col("cx") < F.col("x0")) | (F.col("cx") > F.col("x1")) | (F.col("cy") < F.col("y0")) | (F.col("cy") > F.col("y1"))
    open_parts = p.where(rim).select("label", "part").distinct()
    holes = p.join(open_parts, ["label", "part"], "left_anti").select(*KEYS)
    return union(cells, holes)


def merge(cells: DataFrame, first: int, step: int, last: int, disc: bool = False) -> DataFrame:
    """Closings with growing radius until a label is one part (or last is reached), joined with the input."""
    out, left, r = None, cells.select(*KEYS), first
    while True:
        now = cut(union(left, close(left, r, disc=disc)))
        several = cut(parts(now).groupBy("label").agg(F.countDistinct("part").alias("n")).where("n > 1").select("label"))
        final = r + step > last
        ready = now if final else now.join(several, "label", "left_anti")
        out = ready if out is None else out.unionByName(ready)
        if final or several.isEmpty():
            return out
        left, r = cut(left.join(several, "label")), r + step


def resolve(cells: DataFrame, share: float = 0.5) -> DataFrame:
    """Overlaps settled: over `share` of the smaller label it is absorbed, else the larger one loses the overlap.

    Labels that overlap, directly or through others, are one group of applyInPandas, in
    which pairs are taken from the largest label down.
    """
    pairs = cells.select("cx", "cy", F.col("label").alias("src")).join(cells.select("cx", "cy", F.col("label").alias("dst")), ["cx", "cy"]).where("src < dst").select("src", "dst").distinct()
    comp = connected_components(pairs).select(F.col("node").alias("label"), "component")
    j = cells.join(comp, "label", "left").withColumn("component", F.coalesce("component", "label"))

    def work(p: pd.DataFrame) -> pd.DataFrame:
        own = {k: set(zip(g["cx"], g["cy"])) for k, g in p.groupby("label")}
        for a in sorted(own, key=lambda k: (-len(own[k]), k)):
            for b in sorted(own, key=lambda k: (-len(own[k]), k)):
                if a == b or a not in own or b not in own or not (both := own[a] & own[b]):
                    continue
                big, small = (a, b) if (len(own[a]), -a) >= (len(own[b]), -b) else (b, a)
                if len(both) > share * len(own[small]):
                    own[big] |= own.pop(small)
                else:
                    own[big] -= both
        rows = [(k, x, y) for k, s in own.items() for x, y in s]
        return pd.DataFrame(rows, columns=KEYS)

    return j.groupBy("component").applyInPandas(work, "label long, cx long, cy long")

