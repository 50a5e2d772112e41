"""Triangulation, constrained hierarchical merging, and density clusters."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from math import fma, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.functions.scalars import distance
from mercato.operators.components import connected_components, join
from mercato.operators.grid import cell, first_radius, grid_join
from mercato.operators.ranking import sequential_ids
from mercato.session import cut


#: Directions from a point; a half disc over an edge holds BESIDE of them, next to the edge's own, to half its length (in all at most sixty degrees).
SECTORS, BESIDE = 24, 3


def _candidates(p: DataFrame, radius: float, first: float, group: str, ends: DataFrame | None = None) -> DataFrame:
    """(group, a, b, ax, ay, bx, by), a < b: pairs in the box of +-radius that can be Delaunay edges, both ends among `ends`, if given.

    An empty circle through two points holds one of the two halves of the disc between
    them, and the half to the left holds the next directions' sectors (up to sixty degrees
    from the edge) to half the edge's length. So an edge is at most twice as long as the
    farther of the nearest points in the sectors on its two sides, seen from either end. Points whose
    bounds exceed the radius of a round go on with a doubled one.
    """
    sector = (F.floor((F.atan2("dy", "dx") / np.pi + 1) * (SECTORS / 2)) % SECTORS).cast("int")
    other = p.select(F.col(group).alias("__g"), F.col("siteId").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    left, r, before, out = p if ends is None else ends, first, -1.0, None
    while True:
        a = left.select(group, F.col("siteId").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
        j = grid_join(other, a, r, "bx", "by", "ax", "ay").where(F.col(group) == F.col("__g")).where("a <> b").drop("__g")
        j = j.withColumns({"dx": F.col("bx") - F.col("ax"), "dy": F.col("by") - F.col("ay")}).withColumns({"k": sector, "d": F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))}).where(F.col("d") <= r)
        beside = j.where("d > 0").groupBy("a").agg(*(F.min(F.when(F.col("k") == k, F.col("d"))).alias(f"n{k}") for k in range(SECTORS)))
        # a millionth more than twice: rounding drops no edge
        side = lambda k, way: F.least(F.lit(float("inf")), *(F.col(f"n{(k + way * i) % SECTORS}") for i in range(1, BESIDE + 1)))  # noqa: E731  least skips nulls
        bound = F.array(*(2.000001 * F.greatest(side(k, 1), side(k, -1)) for k in range(SECTORS)))
        bounds = cut(left.select(F.col("siteId").alias("a")).join(beside, "a", "left").select("a", bound.alias("most")))
        own = j.where((F.col("d") > before) & (F.greatest(F.abs("dx"), F.abs("dy")) <= radius)).join(bounds, "a").where(F.col("d") <= F.get("most", F.col("k"))).drop("most")
        # a pair is met from both of its ends; it stays if both let it
        pair = [group, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
        ends = [F.when(F.col("a") < F.col("b"), F.col(f"{u}{c}")).otherwise(F.col(f"{v}{c}")).alias(f"{u}{c}") for u, v in ("ab", "ba") for c in "xy"]
        own = own.select(*pair, *ends).groupBy(group, "a", "b").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("ax", "ay", "bx", "by"))).where("n = 2").drop("n")
        own = cut(own)
        out = own if out is None else out.unionByName(own)
        if r * r >= 2 * radius * radius:
            return out
        left = cut(left.join(bounds.where(F.array_max("most") > r).select(F.col("a").alias("siteId")), "siteId", "left_semi"))
        if left.isEmpty():
            return out
        r, before = r * 2, r


#: Points that a square of the halo's side holds about, halos a tile's side, and values of a block in memory.
HALO, SIDE, BLOCK = 128, 4, 1 << 21
#: Cotangents that differ by less, but do, may be equal up to rounding.
ROUNDING = 1e-12


def _gathered(x: np.ndarray, y: np.ndarray, ask: np.ndarray, size: float):
    """Blocks (rows of ask, neighbours a row, padded with -1): the points of the nine cells of this size around."""
    cx, cy = np.floor(x / size).astype(np.int64), np.floor(y / size).astype(np.int64)
    cx, cy = cx - cx.min() + 1, cy - cy.min() + 1
    wide = cx.max() + 2
    key = cy * wide + cx
    order = np.argsort(key, kind="stable")
    held = key[order]
    middle = key[ask, None] + np.array([-wide, 0, wide])
    low, high = np.searchsorted(held, middle - 1), np.searchsorted(held, middle + 1, "right")
    many = (high - low).max(1)
    rows = np.argsort(many, kind="stable")
    at = 0
    while at < len(rows):
        n = max(1, min(len(rows) - at, BLOCK // max(1, 3 * int(many[rows[at]]))))
        while n > 1 and n * 3 * int(many[rows[at + n - 1]]) > 2 * BLOCK:
            n //= 2
        some = rows[at : at + n]
        spot = low[some][:, :, None] + np.arange(int(many[some[-1]]))
        found = np.where(spot < high[some][:, :, None], order[np.minimum(spot, len(order) - 1)], -1)
        yield ask[some], found.reshape(len(some), -1)
        at += n


def _wrapped(x: np.ndarray, y: np.ndarray, ask: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, closed): Delaunay edges from each point of ask whose triangles all fit in what is known `size` around it, and which points of ask those are.

    All points at once go around: from the nearest neighbour to the one to the left of that
    edge with the largest angle over it, and so on. Points on one circle are all neighbours,
    and so are points on one place.
    """
    ends, others, closed = [], [], []
    for rows, near in _gathered(x, y, ask, size):
        dx, dy = np.where(near < 0, np.inf, x[near] - x[rows][:, None]), np.where(near < 0, np.inf, y[near] - y[rows][:, None])
        far = np.where(near < 0, np.inf, np.where(near < 0, 0.0, dx) ** 2 + np.where(near < 0, 0.0, dy) ** 2)
        same = (far == 0) & (near != rows[:, None])
        far[far == 0] = np.inf
        first = far.argmin(1)
        met, fits = np.zeros(near.shape, bool), np.zeros(len(rows), bool)
        live = np.flatnonzero(np.isfinite(far[np.arange(len(rows)), first]))
        # rows without a neighbour here are open
        u, v = np.where(np.isfinite(far), dx, 0.0)[live], np.where(np.isfinite(far), dy, 0.0)[live]
        start = at = first[live]
        met[live, at] = True
        for _ in range(near.shape[1]):
            if not len(live):
                break
            i = np.arange(len(live))
            qx, qy = u[i, at][:, None], v[i, at][:, None]
            s = qx * v - qy * u
            left = s > 0
            cot = np.full(s.shape, np.inf)
            np.divide(u * (u - qx) + v * (v - qy), s, out=cot, where=left)
            least = cot.min(1)
            on = left & (cot == least[:, None])
            tied = cot <= (least + ROUNDING * (1 + np.abs(least)))[:, None]
            sure = np.isfinite(least) & (np.sqrt((qx * qx + qy * qy)[:, 0]) * np.sqrt(1 + np.square(np.where(np.isfinite(least), least, 0.0))) <= size * (1 - 1e-9)) & ((tied & left) == on).all(1)
            met[live] |= on & sure[:, None]
            # of points on one circle the last one to the left goes on: its angle from the edge is the largest
            turn = np.where(on, (u * qx + v * qy) / np.where(left, s, 1.0), np.inf)
            after = turn.argmin(1)
            back = on[i, start]
            fits[live[sure & back]] = True
            go = sure & ~back
            live, at, start, u, v = live[go], after[go], start[go], u[go], v[go]
        k, j = np.nonzero((met | same) & fits[:, None])
        ends.append(rows[k])
        others.append(near[k, j])
        closed.append(rows[fits])
    return tuple(np.concatenate(z) if z else np.empty(0, np.int64) for z in (ends, others, closed))


def _dealt(tiled: DataFrame, *keys: str) -> DataFrame:
    """tiled by its keys in as many partitions as shuffles have: their bytes are few, but their work isn't, so they aren't to be merged."""
    return tiled.repartition(int(tiled.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _by_tiles(p: DataFrame, radius: float, halo: float, group: str) -> DataFrame:
    """(group, a, b), a < b: Delaunay edges in the box of +-radius with an end all of whose triangles are known from the points within a halo of it; and (group, a, a) for each other point.

    Points go to a tile and to those that they are a halo from: few are sent twice, no pair is.
    """
    side = halo * SIDE
    spots = lambda c: F.sequence(cell(F.col(c) - halo, side), cell(F.col(c) + halo, side))
    tiled = p.where(F.col(group).isNotNull()).withColumn("tx", F.explode(spots("x"))).withColumn("ty", F.explode(spots("y")))
    tiled = tiled.withColumn("own", (cell(F.col("x"), side) == F.col("tx")) & (cell(F.col("y"), side) == F.col("ty")))

    def work(t: pd.DataFrame) -> pd.DataFrame:
        x, y, ids = t["x"].to_numpy(), t["y"].to_numpy(), t["siteId"].to_numpy()
        x, y = x - np.floor(x.min()), y - np.floor(y.min())
        left, size, found = np.flatnonzero(t["own"].to_numpy()), halo, []
        while len(left) and size > halo / 64:
            many = np.unique(np.floor(x / size) * 1e9 + np.floor(y / size), return_counts=True)[1]
            if (many * many).sum() <= 8 * len(x):
                break
            size /= 2
        while len(left) and size <= halo:
            a, b, closed = _wrapped(x, y, left, size)
            near = (np.abs(x[a] - x[b]) <= radius) & (np.abs(y[a] - y[b]) <= radius)
            found.append((ids[a[near]], ids[b[near]]))
            left, size = np.setdiff1d(left, closed), size * 2
        a, b = (np.concatenate([*(f[k] for f in found), ids[left]]) for k in (0, 1))
        return pd.DataFrame({group: t[group].iloc[0], "a": a, "b": b})

    kinds = {c: p.schema[c].dataType.simpleString() for c in (group, "siteId")}
    met = _dealt(tiled, group, "tx", "ty").groupBy(group, "tx", "ty").applyInPandas(work, f"{group} {kinds[group]}, a {kinds['siteId']}, b {kinds['siteId']}")
    return met.select(group, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def delaunay(points: DataFrame, radius: float, group: str = "town") -> DataFrame:
    """(town, a, b), a < b: Delaunay edges shorter than the box of +-radius.

    An edge holds iff no third point lies on it and the angles opposite to it, the largest
    on each side, sum to at most two right angles: their cotangents sum to zero or more.
    Most points are settled in tiles (_by_tiles); the others' edges among themselves follow.
    Pairs that cannot hold are left out first (_candidates). Third points are sought within
    a halo around the edge's middle. Seen from beyond a halo h an edge of length d has a
    cotangent of (h^2 - d^2 / 4) / (d h) or more, which settles nearly all edges; the others
    are tried again with a doubled halo.
    """
    p = cut(points.select(group, "siteId", F.col("xx").cast("double").alias("x"), F.col("yy").cast("double").alias("y")))
    halo = first_radius(p, 2 * radius, "x", "y", HALO)
    tiles = cut(_by_tiles(p, radius, halo, group))
    settled = tiles.where("a <> b")
    some = cut(p.join(tiles.where("a = b").select(F.col("a").alias("siteId")), "siteId", "left_semi").select(*p.columns))
    if some.isEmpty():
        return settled
    left = _candidates(p, radius, min(halo, radius), group, some)
    left = left.withColumns({"mx": (F.col("ax") + F.col("bx")) / 2, "my": (F.col("ay") + F.col("by")) / 2})
    third = p.select(F.col(group).alias("__g"), F.col("siteId").alias("r"), "x", "y")
    span = p.agg(F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))).first()[0] or 0.0
    done = None
    while True:
        j = grid_join(third, left, halo, "x", "y", "mx", "my").where(F.col(group) == F.col("__g")).where("r <> a and r <> b")
        s = (F.col("bx") - F.col("ax")) * (F.col("y") - F.col("ay")) - (F.col("by") - F.col("ay")) * (F.col("x") - F.col("ax"))
        d = (F.col("x") - F.col("ax")) * (F.col("x") - F.col("bx")) + (F.col("y") - F.col("ay")) * (F.col("y") - F.col("by"))
        j = j.select(group, "a", "b", s.alias("s"), d.alias("d")).withColumn("cot", F.when(F.col("s") != 0, F.col("d") / F.nullif(F.abs("s"), F.lit(0.0))))
        g = j.groupBy(group, "a", "b").agg(F.min(F.when(F.col("s") > 0, F.col("cot"))).alias("l"), F.min(F.when(F.col("s") < 0, F.col("cot"))).alias("r"), F.max(F.when((F.col("s") == 0) & (F.col("d") < 0), 1).otherwise(0)).alias("on"))
        seen = left.join(g, [group, "a", "b"], "left")
        long = distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
        far = F.when((long > 0) & F.lit(halo <= span), (halo * halo - long * long / 4) / F.nullif(long * halo, F.lit(0.0)))
        least = lambda c: F.least(F.col(c), far)  # noqa: E731  null only where nothing is on that side, near or far
        holds = least("l").isNull() | least("r").isNull() | (least("l") + least("r") >= 0)
        fails = (F.coalesce("on", F.lit(0)) == 1) | F.coalesce(F.col("l") + F.col("r") < 0, F.lit(False))
        seen = cut(seen.withColumns({"holds": ~fails & holds, "open": ~fails & ~holds}).drop("l", "r", "on"))
        found = seen.where("holds").select(group, "a", "b")
        done = settled.unionByName(found) if done is None else done.unionByName(found)
        left = seen.where("open").drop("holds", "open")
        if halo > span or left.isEmpty():
            return done
        halo *= 2


def lengths(points: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b, d): edges (a, b) with the distance of their ends."""
    ends = [points.select(F.col("siteId").alias(k), F.col("xx").cast("double").alias(f"{k}x"), F.col("yy").cast("double").alias(f"{k}y")) for k in "ab"]
    return edges.select("a", "b").join(ends[0], "a").join(ends[1], "b").select("a", "b", distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")).alias("d"))


def pruned(edges: DataFrame, distances: DataFrame, eps: float) -> DataFrame:
    """Triangulation edges (a, b) whose pair distance d is under eps."""
    return edges.join(distances, ["a", "b"]).where(F.col("d") < eps)


def ward_tree(ids: list, values: np.ndarray, edges: list[tuple[int, int]]) -> list[tuple]:
    """Merges (left, right, distance, size) of one component, cheapest first, only along edges.

    Nodes 0 .. n-1 are the sites in the order of ids, merge k makes node n + k. Ties fall
    to the smaller node numbers.
    """
    n = len(ids)
    centre = dict(enumerate(values.astype(float).tolist()))
    size = {i: 1 for i in range(n)}
    near: dict[int, set[int]] = {i: set() for i in range(n)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)

    def dist(i: int, j: int) -> float:
        far = 0.0  # fused, as in numpy's norm
        for u, v in zip(centre[i], centre[j]):
            far = fma(u - v, u - v, far)
        return sqrt(2 * size[i] * size[j] / (size[i] + size[j])) * sqrt(far)

    heap = [(dist(a, b), a, b) for a in near for b in near[a] if a < b]
    heapq.heapify(heap)
    out = []
    while heap:
        d, a, b = heapq.heappop(heap)
        if a not in near or b not in near:
            continue
        m = n + len(out)
        centre[m] = [(u * size[a] + v * size[b]) / (size[a] + size[b]) for u, v in zip(centre[a], centre[b])]
        size[m] = size[a] + size[b]
        near[m] = (near.pop(a) | near.pop(b)) - {a, b}
        for c in near[m]:
            near[c] -= {a, b}
            near[c].add(m)
            heapq.heappush(heap, (dist(c, m), c, m))
        out.append((a, b, d, size[m]))
    return out


def cut_tree(n: int, merges: list[tuple], threshold: float, most: float, least: float = 0, inclusive: bool = True) -> list[int]:
    """Group number of each site: the smallest site index of its group.

    A merge is taken iff both its parts were taken whole, d < threshold and the size is at
    most `most` (below it if not inclusive), or if a part is smaller than `least`.
    """
    members: dict[int, list[int]] = {i: [i] for i in range(n)}
    for k, (a, b, d, _) in enumerate(merges):
        if a in members and b in members:
            both = len(members[a]) + len(members[b])
            fits = both <= most if inclusive else both < most
            if (d < threshold and fits) or min(len(members[a]), len(members[b])) < least:
                members[n + k] = members.pop(a) + members.pop(b)
    label = [0] * n
    for m in members.values():
        for i in m:
            label[i] = min(m)
    return label


#: Up to so many edges (16 bytes each) have their components found in one task.
FEW = 1 << 22


def _components(points: DataFrame, edges: DataFrame) -> DataFrame:
    """points with component; ids must be numbers in column n."""
    parts = connected_components(edges, "n0", "n1", few=FEW).withColumnRenamed("node", "n")
    return points.join(parts, "n", "left").withColumn("component", F.coalesce("component", "n"))


def constrained_ward(points: DataFrame, edges: DataFrame, attrs: list[str], threshold: float, most: float, least: float = 0, inclusive: bool = True, merges: bool = False) -> DataFrame:
    """(n, label), or the merge list (component, seq, left, right, d, size).

    points: n (long), attrs. edges: n0, n1. Each connected component is one group of
    applyInPandas: the merge order within a component is sequential by nature, components
    don't interact.
    """
    both = _ward_rows(points, edges, attrs, threshold, most, least, inclusive, merges, not merges)
    return _merges(both) if merges else _labels(both)


def _merges(rows: DataFrame) -> DataFrame:
    return rows.where("n is null").select("component", "seq", "left", "right", "d", "size")


def _labels(rows: DataFrame) -> DataFrame:
    return rows.where("n is not null").select("n", "label")


def _ward_rows(points: DataFrame, edges: DataFrame, attrs: list[str], threshold: float, most: float, least: float, inclusive: bool, merges: bool, labels: bool) -> DataFrame:
    """The rows of the merge list, those of the labels (n, label; component too), or both, from one tree a component."""
    placed = cut(_components(points.select("n", *attrs), edges))
    inner = edges.join(placed.select(F.col("n").alias("n0"), F.col("component").alias("c")), "n0").select(F.col("c").alias("component"), "n0", "n1")

    def work(p: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("n").reset_index(drop=True)
        at = {v: i for i, v in enumerate(p["n"])}
        tree = ward_tree(list(p["n"]), p[attrs].to_numpy(float), [(at[a], at[b]) for a, b in zip(e["n0"], e["n1"]) if a != b])
        long, out = "Int64", []
        if merges:
            seq, (left, right, d, size) = range(len(tree)), list(zip(*tree)) or [[]] * 4
            out.append(pd.DataFrame({"seq": pd.array(seq, long), "left": pd.array(left, long), "right": pd.array(right, long), "d": pd.array(d, "Float64"), "size": pd.array(size, long), "n": pd.array([None] * len(tree), long), "label": pd.array([None] * len(tree), long)}))
        if labels:
            label, none = p["n"].to_numpy()[cut_tree(len(p), tree, threshold, most, least, inclusive)], pd.array([None] * len(p), long)
            out.append(pd.DataFrame({"seq": none, "left": none, "right": none, "d": none.astype("Float64"), "size": none, "n": pd.array(p["n"], long), "label": pd.array(label, long)}))
        return pd.concat(out).assign(component=p["component"].iloc[0])

    schema = "component long, seq long, left long, right long, d double, size long, n long, label long"
    return placed.groupBy("component").cogroup(inner.groupBy("component")).applyInPandas(work, schema)


def dbscan(pairs: DataFrame, points: DataFrame, samples: int = 3) -> DataFrame:
    """(n, label): label is the smallest core of the cluster, -1 for noise; pairs (n0, n1) are the distinct neighbours, both orders, without self."""
    count = pairs.groupBy(F.col("n0").alias("n")).agg((F.count("*") + 1).alias("c"))
    core = points.select("n").join(count, "n", "left").where(F.coalesce("c", F.lit(1)) >= samples).select("n")
    c0, c1 = core.select(F.col("n").alias("n0")), core.select(F.col("n").alias("n1"))
    inner = pairs.join(c0, "n0", "left_semi").join(c1, "n1", "left_semi")
    parts = _components(core, inner).select("n", F.col("component").alias("label"))
    border = pairs.join(core.select(F.col("n").alias("n0")), "n0", "left_anti").join(parts.withColumnRenamed("n", "n1"), "n1").groupBy(F.col("n0").alias("n")).agg(F.min("label").alias("label"))
    return points.select("n").join(parts.unionByName(border), "n", "left").withColumn("label", F.coalesce("label", F.lit(-1).cast("long")))


def dbscan_points(points: DataFrame, eps: float, samples: int = 3) -> DataFrame:
    """dbscan of the points (siteId, xx, yy) within eps (inclusive) of each other; no pair is written or sent.

    Points go to a tile and to those that they are twice eps from, where all neighbours are
    known of what is eps around the tile. A tile gives, for its own cores and the cores near
    them, a link to the least of those that it joins, and for each own point that is no core
    its core neighbours, which are fewer than `samples`.
    """
    p = cut(points.select("siteId", F.col("xx").cast("double").alias("x"), F.col("yy").cast("double").alias("y")))
    reach, side = 2 * eps, 2 * eps * SIDE
    spots = lambda c: F.sequence(cell(F.col(c) - reach, side), cell(F.col(c) + reach, side))
    tiled = p.withColumn("tx", F.explode(spots("x"))).withColumn("ty", F.explode(spots("y")))
    tiled = tiled.withColumns({"x0": F.col("tx") * side, "y0": F.col("ty") * side}).withColumn("own", (cell(F.col("x"), side) == F.col("tx")) & (cell(F.col("y"), side) == F.col("ty")))

    def work(t: pd.DataFrame) -> pd.DataFrame:
        x, y, ids, own = (t[c].to_numpy() for c in ("x", "y", "siteId", "own"))
        x0, y0 = t["x0"].iloc[0], t["y0"].iloc[0]
        ask = np.flatnonzero((x >= x0 - eps) & (x <= x0 + side + eps) & (y >= y0 - eps) & (y <= y0 + side + eps))

        def within(ask):
            for rows, near in _gathered(x, y, ask, eps):
                dx, dy = x[rows][:, None] - x[near], y[rows][:, None] - y[near]
                yield rows, near, (near >= 0) & (near != rows[:, None]) & (np.sqrt(dx * dx + dy * dy) <= eps)

        core = np.zeros(len(x), bool)
        for rows, _, ok in within(ask):
            core[rows] = ok.sum(1) + 1 >= samples
        low, met, out = np.arange(len(x)), core & own, []
        for rows, near, ok in within(np.flatnonzero(own)):
            i, j = np.nonzero(ok & core[near])
            u, v = rows[i], near[i, j]
            inner = core[u]
            met[v[inner]] = True
            join(low, u[inner], v[inner])
            out.append((ids[u[~inner]], ids[v[~inner]], np.zeros((~inner).sum(), bool)))
        met = np.flatnonzero(met)
        out.append((ids[met], ids[low[met]], np.ones(len(met), bool)))
        return pd.DataFrame(dict(zip(("n0", "n1", "core"), (np.concatenate(z) for z in zip(*out)))))

    kind = p.schema["siteId"].dataType.simpleString()
    found = cut(_dealt(tiled, "tx", "ty").groupBy("tx", "ty").applyInPandas(work, f"n0 {kind}, n1 {kind}, core boolean").distinct())
    core = found.where("core")
    parts = cut(_components(core.select(F.col("n0").alias("n")).distinct(), core.where("n0 <> n1")).select("n", F.col("component").alias("label")))
    border = found.where("not core").join(parts.withColumnRenamed("n", "n1"), "n1").groupBy(F.col("n0").alias("n")).agg(F.min("label").alias("label"))
    return p.select(F.col("siteId").alias("n")).join(parts.unionByName(border), "n", "left").withColumn("label", F.coalesce("label", F.lit(-1).cast("long")))


def two_phase(points: DataFrame, pairs: DataFrame | None, edges: DataFrame, attrs: list[str], samples: int = 3, large: int = 20, first: DataFrame | None = None) -> DataFrame:
    """(n, label, sub): density clusters, those of `large` or more members split by constrained merging. first: the density clusters (n, label), if they are there already."""
    first = dbscan(pairs, points, samples) if first is None else first
    big = first.where("label >= 0").groupBy("label").count().where(F.col("count") >= large).select("label")
    inside = first.join(big, "label")
    e = edges.join(inside.select(F.col("n").alias("n0"), F.col("label").alias("l0")), "n0").join(inside.select(F.col("n").alias("n1"), F.col("label").alias("l1")), "n1").where("l0 = l1").select("n0", "n1")
    sub = constrained_ward(points.join(inside.select("n"), "n"), e, attrs, 1.0, 100, 5, inclusive=False)
    return first.join(sub.withColumnRenamed("label", "sub"), "n", "left").withColumn("sub", F.coalesce("sub", "label"))


def nearest(points: DataFrame, k: int, radius: float, of: DataFrame | None = None) -> DataFrame:
    """(a, b, d, rank): the k nearest others of each point, ties by id; the nearest points of each place in `of`, if given.

    The search begins in the box of +-radius, or of less where points stand close. Points
    with fewer than k others within it are tried again with a doubled one, until it spans
    all points.
    """
    place = lambda df, a, x, y: df.select(F.col("siteId").alias(a), F.col("xx").cast("double").alias(x), F.col("yy").cast("double").alias(y))
    done, left, others = None, place(points if of is None else of, "a", "ax", "ay"), place(points, "b", "bx", "by")
    every = others.select("bx", "by").union(left.select("ax", "ay"))
    span = every.agg(F.greatest(F.max("bx") - F.min("bx"), F.max("by") - F.min("by"))).first()[0] or 0.0
    apart = F.col("a") != F.col("b") if of is None else F.lit(True)
    w = Window.partitionBy("a")
    radius = first_radius(others, radius, "bx", "by", max(4, k))
    while True:
        p = grid_join(left, others, radius, "ax", "ay", "bx", "by").where(apart).select("a", "b", distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")).alias("d"))
        p = p.withColumns({"rank": F.row_number().over(w.orderBy("d", "b")), "n": F.count(F.when(F.col("d") <= radius, 1)).over(w)})
        best = p.where((F.col("rank") <= k) & ((F.col("n") >= k) | F.lit(radius >= span)))
        best = cut(best.select("a", "b", "d", "rank"))
        done = best if done is None else done.unionByName(best)
        left = cut(left.join(best.select("a"), "a", "left_anti"))
        if radius >= span or left.isEmpty():
            return done
        radius *= 2


def voronoi(cells: DataFrame, points: DataFrame, size: float, radius: float) -> DataFrame:
    """(label, cx, cy, n): the cells of shapes, split among the points by the nearest one to a cell's centre, ties by id."""
    at = cells.select("cx", "cy").distinct().withColumn("siteId", F.struct("cx", "cy"))
    at = at.withColumns({"xx": (F.col("cx") + 0.5) * size, "yy": (F.col("cy") + 0.5) * size})
    near = nearest(points, 1, radius, at).select("a.cx", "a.cy", F.col("b").alias("n"))
    return cells.join(near, ["cx", "cy"]).select("label", "cx", "cy", "n")


def side_filter(points: DataFrame, edges: DataFrame, limit: float = 120.0, share: float = 1.01, group: str = "town") -> DataFrame:
    """Triangulation edges (town, a, b) that are, in some triangle, under the limit and under `share` times the sum of its other sides.

    Triangles are three edges that close. edges must hold all sides of the triangles wanted.
    """
    at = points.select("siteId", F.col("xx").cast("double").alias("x"), F.col("yy").cast("double").alias("y"))
    ends = [at.select(F.col("siteId").alias(k), F.col("x").alias(f"{k}x"), F.col("y").alias(f"{k}y")) for k in "ab"]
    long = edges.join(ends[0], "a").join(ends[1], "b").select("a", "b", distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")).alias("d"))
    both = cut(long.unionByName(long.select(F.col("b").alias("a"), F.col("a").alias("b"), "d")))
    first, second = both.select("a", F.col("b").alias("c"), F.col("d").alias("d1")), both.select(F.col("a").alias("c"), "b", F.col("d").alias("d2"))
    t = long.join(first, "a").join(second, ["c", "b"])
    ok = t.where((F.col("d") < limit) & (F.col("d") < share * (F.col("d1") + F.col("d2")))).select("a", "b").distinct()
    return long.join(ok, ["a", "b"], "left_semi")


def join_labels(points: DataFrame, labels: DataFrame) -> DataFrame:
    """points (n, ..) with their label; a point without one is an error."""
    from mercato.operators.zones import checked_join

    return checked_join(points, labels, "n")


def joining(points: DataFrame, distances: DataFrame | Callable[[DataFrame], DataFrame], eps: float, group: str = "town") -> DataFrame:
    """(n0, n1): the triangulation edges with a distance under eps, by which smpc joins sites."""
    sides = cut(delaunay(points, eps, group).select("a", "b"))
    return cut(pruned(sides, distances(sides) if callable(distances) else distances, eps).select(F.col("a").alias("n0"), F.col("b").alias("n1")))


def smpc(points: DataFrame, distances: DataFrame | Callable[[DataFrame], DataFrame], attrs: list[str], eps: float, threshold: float, most: float, group: str = "town", edges: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(merges, labels): spatially constrained clustering from end to end.

    points: siteId (long), town, xx, yy, attrs. distances: a, b, d, rounded to metres as they
    are stored, or a function that gives them for edges (a, b). Triangulation edges with a distance under eps join sites; each component's
    Ward tree is cut. edges: what joining() gives, if it's there already. merges: seq, cid0, cid1, mcid, d, size: first a row a site with cid0
    `0`, then the merges, component by component, whose ids are `m0`, `m1`, .. labels: n,
    label, ranked from 1 by the smallest site of the cluster.
    """
    edges = joining(points, distances, eps, group) if edges is None else edges
    p = points.withColumnRenamed("siteId", "n")
    rows = cut(_ward_rows(p, edges, attrs, threshold, most, 0, True, True, True))
    tree, found = _merges(rows), _labels(rows)
    base = sequential_ids(p.select("n"), "n")
    singles = base.select("seq", F.lit("0").alias("cid0"), F.col("n").cast("string").alias("cid1"), F.col("n").cast("string").alias("mcid"), F.lit(0.0).alias("d"), F.lit(1).cast("long").alias("size"))
    number = sequential_ids(tree, "component", "k", then=("seq",))
    members = rows.where("n is not null").select("n", "component")
    inside = members.select("component", F.row_number().over(Window.partitionBy("component").orderBy("n")).alias("i"), "n").withColumn("i", F.col("i") - 1)
    sizes = members.groupBy("component").agg(F.count("*").alias("many"))
    t = number.join(sizes, "component")
    first = t.groupBy("component").agg(F.min("k").alias("first"))
    t = t.join(first, "component")
    for side in ("left", "right"):
        own = inside.select("component", F.col("i").cast("long").alias(side), F.col("n").cast("string").alias(f"id_{side}"))
        t = t.join(own, ["component", side], "left")
        t = t.withColumn(f"id_{side}", F.coalesce(f"id_{side}", F.concat(F.lit("m"), F.col("first") + F.col(side) - F.col("many"))))
    n = points.count()
    made = t.select((F.col("k") + n).alias("seq"), F.col("id_left").alias("cid0"), F.col("id_right").alias("cid1"), F.concat(F.lit("m"), F.col("k")).alias("mcid"), "d", "size")
    heads = sequential_ids(found.select("label").distinct(), "label").select("label", (F.col("seq") + 1).alias("rank"))
    return singles.unionByName(made), found.join(heads, "label").select("n", F.col("rank").alias("label"))


def sub_label(label: Column, sub: Column) -> Column:
    """A label of two levels: `a-07`."""
    return F.concat_ws("-", label.cast("string"), F.lpad(sub.cast("string"), 2, "0"))
