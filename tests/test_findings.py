"""Queries against their SQL on tables made for a finding."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mercato.operators import clusters, grid, network, ranking, zones
from mercato.operators.components import connected_components
from mercato.plans.more import ORACLES, QUERIES

#: Places of a business are (k * 7919) % 2003 and (k * 104729) % 1999, offset by its town's corner.
_PERIOD = 2003 * 1999


def _key(x: int, y: int) -> int:
    """The key whose place in its town is x, y."""
    a, b = x * pow(7919, -1, 2003) % 2003, y * pow(104729, -1, 1999) % 1999
    return (a + 2003 * ((b - a) * pow(2003, -1, 1999) % 1999)) % _PERIOD


def _customers(folder, places) -> str:
    """A folder with customers at places (town, x, y) of their town; keys ending in 9 stand with the one before, so are shifted."""
    keys = [(k if k % 10 != 9 else k + _PERIOD, town) for town, x, y in places for k in [_key(x, y)]]
    pd.DataFrame([(k, f"c{k}", town, 0.0, "BUILDING") for k, town in keys], columns=["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]).astype({"c_nationkey": "int32"}).to_parquet(folder / "customer.parquet")
    return str(folder)


def _same(spark, name: str, folder: str, tables=("customer",)) -> list:
    """The query's rows, which must be those of its SQL."""
    c = duckdb.connect()
    for t in tables:
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    r = c.execute(ORACLES[name])
    at = {x[0]: i for i, x in enumerate(r.description)}
    got = QUERIES[name](spark, folder)
    cols = sorted(got.columns)
    assert sorted(at) == cols
    rows = sorted(map(repr, (tuple(x) for x in got.select(*cols).collect())))
    assert rows == sorted(repr(tuple(x[at[n]] for n in cols)) for x in r.fetchall())
    return rows


@pytest.mark.parametrize("name, places, inside", [
    ("f1_point_in_polygon", [(15, 530, 1980), (15, 531, 1946), (0, 1100, 1500), (0, 10, 10)], 3),
    ("f1_rings_with_holes", [(0, 501, 600), (0, 502, 700), (15, 312, 137), (15, 1900, 900), (0, 10, 10)], 4),
])
def test_points_on_outlines(spark, tmp_path, name, places, inside):
    """a point on a left side counts, as in the SQL."""
    assert len(_same(spark, name, _customers(tmp_path, places))) == inside


def test_snap_on_a_dense_lattice(spark):
    """Short parts start a short search, and the answer is the nearest by brute force."""
    r = random.Random(4)
    seg = [(f"{i}-{j}-{k}", 4.0 * i, 4.0 * j, 4.0 * (i + 1 - k), 4.0 * (j + k)) for i in range(40) for j in range(40) for k in (0, 1)]
    sites = [(str(i), r.randrange(170), r.randrange(170)) for i in range(60)] + [("far", 900, -700)]
    lines = spark.createDataFrame(seg, "segId string, x0 double, y0 double, x1 double, y1 double")
    parts = lines.withColumns({"before": F.lit(0.0), "total": F.lit(4.0)})
    assert network._first_radius(parts, 300.0) <= 8 and network._first_radius(parts.limit(0), 300.0) == 300.0

    def place(px, py, x0, y0, x1, y1):
        t = min(max(((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / 16, 0.0), 1.0)
        return math.sqrt((px - x0 - t * (x1 - x0)) ** 2 + (py - y0 - t * (y1 - y0)) ** 2)

    got = network.snap(spark.createDataFrame(sites, "siteId string, xx long, yy long"), lines).collect()
    assert {x.siteId: (x.dist, x.segId) for x in got} == {n: min((place(px, py, *s[1:]), s[0]) for s in seg) for n, px, py in sites}


def test_triangulation_of_dense_points(spark):
    """Few pairs are left to judge, none of the triangulation's is lost, lattices and outliers included."""
    r = random.Random(8)
    some = {(r.randrange(60), r.randrange(60)) for _ in range(120)} | {(70 + 3 * i, 3 * j) for i in range(6) for j in range(6)} | {(190, 20), (30, 150), (-90, -100)}
    pts = [(k, 0, x, y) for k, (x, y) in enumerate(sorted(some))]
    frame = spark.createDataFrame(pts, "siteId long, town long, xx long, yy long")

    def holds(a, b):
        least = {1: None, -1: None}
        for k, _, x, y in pts:
            if k not in (a[0], b[0]):
                s = (b[2] - a[2]) * (y - a[3]) - (b[3] - a[3]) * (x - a[2])
                d = (x - a[2]) * (x - b[2]) + (y - a[3]) * (y - b[3])
                if s == 0 and d < 0:
                    return False
                if s:
                    way = 1 if s > 0 else -1
                    least[way] = d / abs(s) if least[way] is None else min(least[way], d / abs(s))
        return None in least.values() or sum(least.values()) >= 0

    near = [(a, b) for a in pts for b in pts if a[0] < b[0] and abs(a[2] - b[2]) <= 150 and abs(a[3] - b[3]) <= 150]
    want = {(a[0], b[0]) for a, b in near if holds(a, b)}
    assert {(x.a, x.b) for x in clusters.delaunay(frame, 150.0).collect()} == want
    p = frame.select("town", "siteId", F.col("xx").cast("double").alias("x"), F.col("yy").cast("double").alias("y"))
    left = {(x.a, x.b) for x in clusters._candidates(p, 150.0, 8.0, "town").collect()}
    assert want <= left and len(left) < len(near) / 4


def test_nearest_starts_small_on_dense_points(spark):
    """the search starts at the points' own spacing."""
    r = random.Random(3)
    pts = [(i, r.randrange(200), r.randrange(200)) for i in range(300)] + [(900, 4000, 0)]
    frame = spark.createDataFrame(pts, "siteId long, xx long, yy long")
    assert grid.first_radius(frame, 400.0, "xx", "yy") < 60
    want = {(a, b, k + 1) for a, x, y in pts for k, (_, b) in enumerate(sorted(((x - u) ** 2 + (y - v) ** 2, b) for b, u, v in pts if b != a)[:4])}
    assert {(x.a, x.b, x.rank) for x in clusters.nearest(frame, 4, 400.0).collect()} == want


def test_attributes_and_scaled_pairs_send_no_pairs(spark):
    """results as from the pair table, without one."""
    r = random.Random(5)
    sites = spark.createDataFrame([(str(i), r.randrange(1500), r.randrange(1500)) for i in range(150)] + [("far", 9000, 9000)], "siteId string, xx long, yy long")
    flags = sites.where("siteId <> 'far' and siteId % 3 <> 1").select("siteId", (F.col("xx") % 3).alias("u"), (F.col("yy") % 2).alias("v"))
    half = zones.box_pairs(sites, 400).where("a <= b").select(F.col("a").alias("siteId0"), F.col("b").alias("siteId1"), "d")
    key = lambda df, c: sorted(tuple(round(v, 8) if isinstance(v, float) else v for v in x) for x in df.select(*c).collect())
    assert key(zones.box_attributes(sites, flags, ["u", "v"]), ["siteId", "u", "v"]) == key(zones.attributes(flags, half, ["u", "v"]), ["siteId", "u", "v"])
    factors = sites.select("siteId", (F.col("xx") % 7 / 7).alias("factor"))
    got = zones.scaled_box_pairs(sites, factors, 400)
    assert key(got, ["siteId0", "siteId1", "d"]) == key(zones.scaled_distances(half, factors), ["siteId0", "siteId1", "d"])


def test_paths_in_blocks_and_by_rounds(spark, monkeypatch):
    """components are searched in blocks of sources; those too large for that by rounds, with the same times."""
    r = random.Random(9)
    edges = [(a, b, float(r.randrange(50, 400))) for a in range(30) for b in r.sample(range(30), 3) if a < b] + [(100, 101, 5.5), (101, 102, 1200.0), (200, 200, 1.0)]
    e = spark.createDataFrame(edges, "a long, b long, time double")
    src = spark.createDataFrame([(n,) for n in [*range(30), 100, 102, 200, 999]], "node long")
    key = lambda df: sorted(tuple(x) for x in df.select("src", "node", "time").collect())
    want = key(network.bounded_paths(e, src, 700.0, max_rounds=50))
    monkeypatch.setattr(network, "PLACES", 200)
    assert key(network.bounded_paths(e, src, 700.0)) == want
    monkeypatch.setattr(network, "NODES", 5)
    assert key(network.bounded_paths(e, src, 700.0)) == want


def test_road_distances_in_blocks_and_by_joins(spark, monkeypatch):
    """distances, boxes, factors and densities made block by block are those of the joined paths, which hold no pair of sites."""
    r = random.Random(6)
    edges = [(f"{a}-{b}", a, b, float(r.randrange(50, 400))) for a in range(30) for b in r.sample(range(30), 3) if a < b] + [("100-101", 100, 101, 5.5), ("101-102", 101, 102, 900.0), ("200-200", 200, 200, 1.0)]
    e = spark.createDataFrame(edges, "segId string, a long, b long, time double")
    on = [(str(k), seg, float(r.randrange(40)), 50.0, r.randrange(500), r.randrange(500), r.randrange(1, 9) / 8) for k in range(90) for seg in [r.choice(edges)[0]]] + [("off", "none", 3.0, 9.0, 1, 1, 0.5), ("off2", "none", 7.0, 9.0, 900, 1, 0.25)]
    sites = spark.createDataFrame(on, "siteId string, segId string, along double, len double, xx long, yy long, factor double")
    key = lambda df: sorted(tuple(round(v, 8) if isinstance(v, float) else v for v in x) for x in df.select(*sorted(df.columns)).collect())
    plain = sites.drop("xx", "yy", "factor")
    want = network._distances_by_joins(plain, e, 700.0)
    boxed = network._of_sites(want, sites, 200.0, True)
    pairs = want.withColumn("distance", F.bround("distance", 1))
    dense = zones.pair_density(plain, pairs, 600.0).select("siteId", "density").where("siteId not like 'off%'")
    weights = zones.kernel_weights
    for nodes, block, held in ((1 << 18, 2048, 1 << 20), (1 << 18, 20, 64), (5, 20, 64)):
        for name, value in (("NODES", nodes), ("BLOCK", block), ("HELD", held), ("PAIRS", 7)):
            monkeypatch.setattr(network, name, value)
        assert key(network.site_distances(plain, e, 700.0)) == key(want)
        assert key(network.site_distances(sites, e, 700.0, box=200.0)) == key(boxed)
        assert key(network.site_density(plain, e, weights, cutoff=700.0).where("siteId not like 'off%'")) == key(dense)
    twice = zones.both_orders(want.where("distance < 90"))
    assert key(twice) == key(want.where("distance < 90").unionByName(want.where("distance < 90 and siteId0 <> siteId1").select(F.col("siteId1").alias("siteId0"), F.col("siteId0").alias("siteId1"), "distance")))


def test_percentiles_of_many_columns_share_passes(spark):
    """the passes over the rows don't grow with the columns, and the percentiles are exact."""
    r = random.Random(8)
    rows = [(r.gauss(0, 1), float(r.randrange(3)), None, r.random() ** 9, 5.0, None if i % 2 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double").repartition(4).cache()
    df.count()
    wanted = {f"{c}{q}": (c, q) for c in "abcdef" for q in (0.0, 0.2, 0.9, 1.0)}
    spark.sparkContext.setJobGroup("F3", "percentiles")
    got = ranking.percentiles(df, wanted, buckets=64)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("F3"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    pdf = df.toPandas().astype(float)
    for k, (c, q) in wanted.items():
        assert got[k] is None if c == "c" else got[k] == pytest.approx(pdf[c].quantile(q), abs=1e-12)
    assert jobs <= 30


@pytest.mark.parametrize("kind", ["integers", "reals", "lattice"])
def test_triangulation_in_tiles(spark, monkeypatch, kind):
    """Most points are settled in tiles, from what is a halo around; all edges are those of brute force, with points on one circle, on one place, in two groups and far away."""
    r = random.Random(12)
    place = {"integers": lambda: (r.randrange(60), r.randrange(60)), "reals": lambda: (r.random() * 60, r.random() * 60), "lattice": lambda: (4 * r.randrange(15), 4 * r.randrange(15))}[kind]
    pts = [(k, k % 2, *map(float, place())) for k in range(240)] + [(500, 0, 200.0, 90.0), (501, 1, -170.0, 3.0), (502, None, 30.0, 30.0)]
    pts += [(600 + k, g, x, y) for k, (_, g, x, y) in enumerate(pts[:6])]
    frame = spark.createDataFrame(pts, "siteId long, town long, xx double, yy double")

    def holds(a, b):
        least = {1: math.inf, -1: math.inf}
        for k, g, x, y in pts:
            if g == a[1] and k not in (a[0], b[0]):
                s = (b[2] - a[2]) * (y - a[3]) - (b[3] - a[3]) * (x - a[2])
                d = (x - a[2]) * (x - b[2]) + (y - a[3]) * (y - b[3])
                if s == 0 and d < 0:
                    return False
                if s:
                    least[1 if s > 0 else -1] = min(least[1 if s > 0 else -1], d / abs(s))
        return sum(least.values()) >= 0

    want = {(a[0], b[0]) for a in pts for b in pts if a[0] < b[0] and a[1] == b[1] is not None and abs(a[2] - b[2]) <= 150 and abs(a[3] - b[3]) <= 150 and holds(a, b)}
    p = frame.select("town", "siteId", F.col("xx").alias("x"), F.col("yy").alias("y"))
    for held, side in ((128, 4), (40, 1)):
        monkeypatch.setattr(clusters, "HALO", held)
        monkeypatch.setattr(clusters, "SIDE", side)
        assert {(x.a, x.b) for x in clusters.delaunay(frame, 150.0).collect()} == want
    tiles = {(x.a, x.b) for x in clusters._by_tiles(p, 150.0, 30.0, "town").collect()}
    assert {e for e in tiles if e[0] != e[1]} <= want
    assert len({a for a, b in tiles if a == b}) < len(pts) / 2


def test_components_of_few_edges_in_one_task(spark):
    """components found in one task are those of the rounds."""
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1200)] + [(7, 7), (None, 3), (5, None)]
    e = spark.createDataFrame(edges, "src long, dst long")
    want = sorted(map(tuple, connected_components(e).collect()))
    assert sorted(map(tuple, connected_components(e, few=1 << 10).collect())) == want
    assert sorted(map(tuple, connected_components(e, few=20).collect())) == want
    assert connected_components(e.limit(0), few=20).collect() == []


def test_merges_and_labels_of_one_tree(spark):
    """one tree gives the merge list and the labels."""
    r = random.Random(4)
    p = spark.createDataFrame([(n, r.random(), r.random()) for n in range(40)], "n long, u double, v double")
    e = spark.createDataFrame([(n, n + 1) for n in range(39) if n not in (9, 30)], "n0 long, n1 long")
    both = clusters._ward_rows(p, e, ["u", "v"], 0.6, 8, 0, True, True, True).collect()
    merges, labels = (sorted(tuple(x) for x in clusters.constrained_ward(p, e, ["u", "v"], 0.6, 8, merges=m).collect()) for m in (True, False))
    assert sorted((x.component, x.seq, x.left, x.right, x.d, x.size) for x in both if x.n is None) == merges and len(merges) == 37
    assert sorted((x.n, x.label) for x in both if x.n is not None) == labels and len(labels) == 40


def test_density_clusters_from_points(spark, monkeypatch):
    """density clusters without pairs are those of the pairs, over tiles, with border points and noise."""
    r = random.Random(21)
    pts = [(k, r.randrange(400), r.randrange(400)) for k in range(160)] + [(200 + k, 10 * k, 500) for k in range(30)] + [(300, 5, 5), (301, 5, 5), (302, 900, 900)]
    frame = spark.createDataFrame(pts, "siteId long, xx long, yy long")
    pairs = [(a, b) for a, x, y in pts for b, u, v in pts if a != b and math.sqrt((x - u) ** 2 + (y - v) ** 2) <= 25]
    want = clusters.dbscan(spark.createDataFrame(pairs, "n0 long, n1 long"), frame.select(F.col("siteId").alias("n")))
    want = sorted(map(tuple, want.select("n", "label").collect()))
    assert {-1, 200} < {x[1] for x in want}
    monkeypatch.setattr(clusters, "SIDE", 1)
    assert sorted(map(tuple, clusters.dbscan_points(frame, 25.0).select("n", "label").collect())) == want


@pytest.mark.parametrize("kind", ["whole", "thirds", "real"])
def test_times_from_tiles_of_sources(monkeypatch, kind):
    """A tile of sources looks only at what it reaches, or at what its pairs need; times are those of a search from each, the cutoff included."""
    r = random.Random(7)
    n, cutoff = 400, 180.0
    time = {"whole": lambda: 6.0 * r.randrange(1, 6), "thirds": lambda: r.randrange(20, 70) / 3, "real": lambda: r.uniform(5, 25)}[kind]
    links = [(k, k + s, time()) for k in range(n) for s in (1, 20) if k + s < n and (s == 20 or k % 20 < 19)] + [(0, 399, 900.0), (7, 7, 1.0), (3, 4, 0.0)]
    near, to, t = (np.array(v) for v in zip(*links, *((b, a, w) for a, b, w in links)))
    roads = network.Roads(near, to, t, n, cutoff)
    assert (roads.unit is None) == (kind == "real")
    x, y = np.arange(n) % 20, np.arange(n) // 20
    groups = network.tiles(x, y, 40)
    assert sorted(np.concatenate(groups)) == list(range(n)) and all(np.ptp(x[g]) < 8 and np.ptp(y[g]) < 8 for g in groups)
    monkeypatch.setattr(network, "GROUP", 8)
    want = np.full((n, n), np.inf)
    want[np.arange(n), np.arange(n)] = 0
    while True:
        old = want.copy()
        for a, b, w in zip(near, to, t):
            np.minimum(want[b], want[a] + w, out=want[b])
        if np.array_equal(old, want):
            break
    want[want > cutoff + 1e-9] = np.inf
    looked = 0
    for g in groups:
        nodes, labels = roads.times(g)
        got = np.full((n, len(g)), np.inf)
        got[nodes] = roads.times_at(labels)
        assert np.allclose(got, want[:, g], atol=1e-9)
        looked += len(nodes) < n
        need = np.flatnonzero((np.abs(x - x[g].mean()) < 6) & (np.abs(y - y[g].mean()) < 6))
        few, labels = network._times_needed(roads, g, need)
        got[few] = roads.times_at(labels)
        assert np.allclose(got[need], want[need][:, g], atol=1e-9) and len(few) <= len(nodes)
    assert looked > len(groups) / 2
