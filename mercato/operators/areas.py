"""Areas as rings (area, ring, seq, x, y), their cells, and joins of areas with points and areas.

Ring order and direction don't matter: what lies inside an odd number of rings is inside,
so inner rings are holes. A ring needn't repeat its first point.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.operators import cells as C
from mercato.operators.grid import cell


def projected(rings: DataFrame, forward) -> DataFrame:
    """The geometry under a coordinate function of two columns, all other columns kept."""
    x, y = forward(F.col("x"), F.col("y"))
    return rings.withColumns({"x": x, "y": y})


def sides(rings: DataFrame) -> DataFrame:
    """(area, x0, y0, x1, y1): the sides of the rings, closed."""
    w = Window.partitionBy("area", "ring").orderBy("seq")
    first = F.first(F.struct("x", "y")).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    to = F.coalesce(F.lead(F.struct("x", "y")).over(w), first)
    s = rings.withColumn("to", to).select("area", F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("to.x").alias("x1"), F.col("to.y").alias("y1"))
    return s.where("x0 <> x1 or y0 <> y1")


def points_inside(points: DataFrame, rings: DataFrame, strip: float = 1000.0, x: str = "xx", y: str = "yy", half_open: bool = False) -> DataFrame:
    """points with the area they lie strictly inside, a row an area; points on an outline are outside.

    half_open: a point on an outline belongs to the area to its right (above it on a level
    side), so areas that share a side share no point and lose none.
    Sides and points meet by strips of y, so a point is compared with the sides of its strip alone.
    """
    s = sides(rings).withColumn("strip", F.explode(F.sequence(cell(F.least("y0", "y1"), strip), cell(F.greatest("y0", "y1"), strip))))
    own = points.withColumn("strip", cell(F.col(y), strip)).withColumn("px", F.col(x).cast("double")).withColumn("py", F.col(y).cast("double"))
    j = own.join(s, "strip").where((F.col("py") >= F.least("y0", "y1")) & (F.col("py") <= F.greatest("y0", "y1")))
    cross = (F.col("x1") - F.col("x0")) * (F.col("py") - F.col("y0")) - (F.col("y1") - F.col("y0")) * (F.col("px") - F.col("x0"))
    on = (cross == 0) & F.col("px").between(F.least("x0", "x1"), F.greatest("x0", "x1"))
    spans = (F.col("y0") > F.col("py")) != (F.col("y1") > F.col("py"))
    right = spans & F.when(F.col("y1") > F.col("y0"), cross > 0).otherwise(cross < 0)
    names = points.columns
    hit = j.groupBy(*names, "area").agg(F.sum(right.cast("int")).alias("odd"), F.max(on.cast("int")).alias("rim"))
    return hit.where("odd % 2 = 1" if half_open else "odd % 2 = 1 and rim = 0").select(*names, "area")


def cells_of(rings: DataFrame, size: float) -> DataFrame:
    """(label, cx, cy): cells whose centre is inside an area, row by row between its outline's crossings."""
    s = sides(rings)
    low, high = F.least("y0", "y1") / size, F.greatest("y0", "y1") / size
    rows = F.sequence(F.ceil(low - 0.5).cast("long"), (F.ceil(high - 0.5) - 1).cast("long"))
    s = s.where(F.ceil(low - 0.5) <= F.ceil(high - 0.5) - 1).withColumn("cy", F.explode(rows))
    at = F.col("x0") + ((F.col("cy") + 0.5) * size - F.col("y0")) * (F.col("x1") - F.col("x0")) / F.nullif(F.col("y1") - F.col("y0"), F.lit(0.0))
    r = s.groupBy("area", "cy").agg(F.sort_array(F.collect_list(at / size)).alias("at"))  # crossings of one row of one area
    r = r.select("area", "cy", F.posexplode("at").alias("k", "from"), "at").where("k % 2 = 0").withColumn("to", F.get("at", F.col("k") + 1))
    lo, hi = F.ceil(F.col("from") - 0.5).cast("long"), (F.ceil(F.col("to") - 0.5) - 1).cast("long")
    return r.where(lo <= hi).select(F.col("area").alias("label"), F.explode(F.sequence(lo, hi)).alias("cx"), "cy").distinct()


def outline(cells: DataFrame) -> DataFrame:
    """(label, x0, y0, x1, y1): sides of cells that no cell of the label shares, the inside to their left, in cells."""
    four = [((0, 0), (1, 0), (0, -1)), ((1, 0), (1, 1), (1, 0)), ((1, 1), (0, 1), (0, 1)), ((0, 1), (0, 0), (-1, 0))]
    side = F.array(*(F.struct(*(F.lit(v).cast("long").alias(n) for n, v in zip(("a", "b", "c", "d", "i", "j"), (*p, *q, *o)))) for p, q, o in four))
    c = cells.select(*C.KEYS).distinct()
    s = c.withColumn("s", F.explode(side)).select("label", "cx", "cy", "s.*")
    beside = c.select("label", F.col("cx").alias("nx"), F.col("cy").alias("ny"))
    s = s.join(beside, (s["label"] == beside["label"]) & (F.col("cx") + F.col("i") == F.col("nx")) & (F.col("cy") + F.col("j") == F.col("ny")), "left_anti")
    return s.select("label", (F.col("cx") + F.col("a")).alias("x0"), (F.col("cy") + F.col("b")).alias("y0"), (F.col("cx") + F.col("c")).alias("x1"), (F.col("cy") + F.col("d")).alias("y1"))


def rings_of(cells: DataFrame, size: float) -> DataFrame:
    """(area, ring, seq, x, y): the outlines of cell sets, corners only; holes run clockwise.

    The sides of one label's outline are chained in one group: its outline, not its area.
    """

    def work(p: pd.DataFrame) -> pd.DataFrame:
        out: dict[tuple, list[tuple]] = {}
        for a, b, c, d in zip(p["x0"], p["y0"], p["x1"], p["y1"]):
            out.setdefault((a, b), []).append((c, d))
        rows, ring = [], 0
        for start in sorted(out):
            while out.get(start):
                at, path, way = start, [], None
                while True:
                    ways = out[at]
                    if way is not None and len(ways) > 1:  # cells that touch at a corner: turn left, so rings stay apart
                        left = (at[0] - way[1], at[1] + way[0])
                        to = ways.pop(ways.index(left)) if left in ways else ways.pop()
                    else:
                        to = ways.pop()
                    step = (to[0] - at[0], to[1] - at[1])
                    if step != way:
                        path.append(at)
                    at, way = to, step
                    if at == start:
                        break
                rows += [(p["label"].iloc[0], ring, k, float(x) * size, float(y) * size) for k, (x, y) in enumerate(path)]
                ring += 1
        return pd.DataFrame(rows, columns=["area", "ring", "seq", "x", "y"])

    return outline(cells).groupBy("label").applyInPandas(work, "area long, ring long, seq long, x double, y double")


def polygons(rings: DataFrame) -> DataFrame:
    """(area, rings): one row an area, rings as arrays of points for a polygon sink."""
    r = rings.groupBy("area", "ring").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("p"))
    closed = F.concat(F.col("p"), F.slice("p", 1, 1))
    r = r.select("area", "ring", F.transform(closed, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"))).alias("p"))
    return r.groupBy("area").agg(F.transform(F.sort_array(F.collect_list(F.struct("ring", "p"))), lambda s: s["p"]).alias("rings"))


# joins on shared cells
def touching(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a, b, cells): labels of two sets of areas that share cells, and how many."""
    x, y = (s.select(F.col("label").alias(n), "cx", "cy").distinct() for s, n in ((a, "a"), (b, "b")))
    return x.join(y, ["cx", "cy"]).groupBy("a", "b").agg(F.count("*").alias("cells"))


def overlap_area(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    return touching(a, b).select("a", "b", (F.col("cells") * size * size).alias("area"))


def points_in(areas: DataFrame, points: DataFrame, size: float, ident: str = "siteId", x: str = "xx", y: str = "yy") -> DataFrame:
    """(label, n): points in each area, 0 where there is none."""
    p = points.select(F.col(ident).alias("point"), cell(F.col(x), size).alias("cx"), cell(F.col(y), size).alias("cy"))
    return areas.join(p, ["cx", "cy"], "left").groupBy("label").agg(F.countDistinct("point").alias("n"))


def meets(areas: DataFrame, others: DataFrame, name: str) -> DataFrame:
    """(label, name): whether an area shares a cell with any of the others; a null table of others meets nothing."""
    yes = areas.join(others.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi").select("label").distinct().withColumn("yes", F.lit(True))
    return areas.select("label").distinct().join(yes, "label", "left").select("label", F.coalesce("yes", F.lit(False)).alias(name))


def residential_only(areas: DataFrame, segments: DataFrame, housing: str = "countHousing") -> DataFrame:
    """(label, residential): areas that touch no segment of another type than `housing`; segments: type, cx, cy."""
    other = meets(areas, segments.where(F.col("type") != housing), "other")
    return other.select("label", (~F.col("other")).alias("residential"))


def parcel_labels(sites: DataFrame, lookup: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, parcel): every label that has a site in the parcel. sites: siteId; lookup: siteId, parcel; labels: siteId, label."""
    return lookup.join(sites.select("siteId"), "siteId", "left_semi").join(labels.select("siteId", "label"), "siteId").select("label", "parcel").distinct()


def large_enough(counts: DataFrame, residential: DataFrame, least: int = 2, least_residential: int = 4) -> DataFrame:
    """Labels with `least` points or more, or least_residential where only residential areas touch."""
    need = F.when(F.col("residential"), least_residential).otherwise(least)
    return counts.join(residential, "label").where(F.col("n") >= need).select("label", "n")


# tiles
def tiles(box: DataFrame) -> DataFrame:
    """(lon, lat): tenths of degrees of the tiles over a box; box: lon0, lon1, lat0, lat1."""
    low, high = lambda c: F.floor(F.col(c) * 10), lambda c: F.ceil(F.col(c) * 10) - 1
    t = box.select(F.explode(F.sequence(low("lon0"), high("lon1"))).alias("lon"), F.sequence(low("lat0"), high("lat1")).alias("lats"))
    return t.select("lon", F.explode("lats").alias("lat"))


def tiles_touching(tiles: DataFrame, areas: DataFrame, cells_a_tile: int) -> DataFrame:
    """Tiles that hold a cell of the areas; cells are in parts of a tile."""
    own = areas.select(F.floor(F.col("cx") / cells_a_tile).alias("lon"), F.floor(F.col("cy") / cells_a_tile).alias("lat")).distinct()
    return tiles.join(own, ["lon", "lat"], "left_semi")


def tile_box(lon: Column, lat: Column) -> Column:
    return F.format_string("%.1f,%.1f,%.1f,%.1f", *((c / 10).cast("double") for c in (lat, lon, lat + 1, lon + 1)))


def tile_file(lon: Column, lat: Column) -> Column:
    return F.format_string("roads_%d_%d.json", F.abs(lon), F.abs(lat))


def road_query(lon: Column, lat: Column) -> Column:
    """The text of a request for the roads of a tile."""
    box = tile_box(lon, lat)
    return F.concat(F.lit("[out:json];(way[highway]("), box, F.lit(");>;);out;"))


def merged_or_round(cells: DataFrame, first: int, step: int, last: int, round_step: int) -> DataFrame:
    """The orthogonal merge; labels that it leaves in several parts take the round merge in its place."""
    square = C.cut(C.merge(cells, first, step, last, disc=False))
    several = C.parts(square).groupBy("label").agg(F.countDistinct("part").alias("n")).where("n > 1").select("label")
    several = C.cut(several)
    other = C.merge(C.cut(cells.join(several, "label", "left_semi")), first, round_step, last, disc=True)
    return square.join(several, "label", "left_anti").unionByName(other)
