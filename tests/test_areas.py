import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import areas, cells, clusters, network, ranking, zones
from mercato.plans.more import ORACLES, QUERIES
from mercato.session import shared_dir
from mercato.sources import psv

SF = "/root/testdata/sf0.001"
QUICK = ["f1_rings_with_holes", "io11_cells_of_rings", "io14_outlines", "pg13_line_parts", "j8_edge_lines", "n1_graph_from_osm", "n2_bounded_paths", "j24_labels_around", "g1_site_list", "p10_fixed_decimals", "m6_connectivity", "m7_knn"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF)
    c = duckdb.connect()
    for t in ("customer", "part", "supplier"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    r = c.execute(ORACLES[name])
    at = {x[0]: i for i, x in enumerate(r.description)}
    cols = sorted(got.columns)
    key = lambda rows: sorted(repr(tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in x)) for x in rows)
    assert sorted(at) == cols and key(got.select(*cols).collect()) == key(tuple(x[at[n]] for n in cols) for x in r.fetchall())


def test_rings_of_cells_and_back(spark):
    r = random.Random(4)
    rows = {(k, r.randrange(9), r.randrange(9)) for k in range(4) for _ in range(45)}
    frame = spark.createDataFrame(sorted(rows), "label long, cx long, cy long")
    rings = areas.rings_of(frame, 10.0)
    assert {tuple(x) for x in areas.cells_of(rings, 10.0).collect()} == rows
    kept = areas.polygons(rings).collect()
    assert len(kept) == 4 and all(p[0] == p[-1] and len(p) >= 5 for a in kept for p in a.rings)
    corner = spark.createDataFrame([(0, 0.0, 0.0), (1, 10.0, 5.0), (2, 5.0, 5.0)], "siteId long, xx double, yy double")
    square = spark.createDataFrame([(7, 0, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])], "area long, ring long, seq long, x double, y double")
    assert [(x.siteId, x.area) for x in areas.points_inside(corner, square).collect()] == [(2, 7)]  # the rim is outside


def test_features_round_trip(spark, tmp_path):
    ring = spark.createDataFrame([(1, 0, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (4.0, 0.0), (0.0, 3.0)])], "area long, ring long, seq long, x double, y double")
    poly = areas.polygons(ring).select(F.lit("a").alias("name"), F.col("rings")[0].alias("points"))
    psv.write_features(poly, "Polygon", "points", ["name"], f"{tmp_path}/p")
    got = psv.read_features(spark, f"{tmp_path}/p").orderBy("seq").collect()
    assert [(x.kind, x.part, x.ring, x.x, x.y) for x in got] == [("Polygon", 0, 0, x, y) for x, y in [(0.0, 0.0), (4.0, 0.0), (0.0, 3.0), (0.0, 0.0)]]
    assert got[0].properties == {"name": "a"} and psv.boundary(spark, f"{tmp_path}/p").count() == 4
    line = spark.createDataFrame([([(1.0, 2.0), (3.0, 4.0)], "x")], "points array<struct<x:double,y:double>>, name string")
    for kind in ("LineString", "Point", "MultiPoint"):
        psv.write_features(line, kind, "points", ["name"], f"{tmp_path}/{kind}")
        back = psv.read_features(spark, f"{tmp_path}/{kind}")
        assert back.count() == (1 if kind == "Point" else 2) and psv.only_polygons(back).count() == 0


def test_tables_on_disk(spark, tmp_path):
    (tmp_path / "t.psv").write_text("name|value\nepsilon|150.0\n")
    one = psv.read_psv(spark, str(tmp_path / "t.psv"), "name string, value double")
    assert psv.single_row(one).value == 150.0 and psv.setting(one, "epsilon") == 150.0 and psv.setting(one, "x") is None
    with pytest.raises(ValueError):
        psv.single_row(one.limit(0))
    assert [tuple(r) for r in psv.read_rows(spark, str(tmp_path / "t.psv"), ["a", "b"]).collect()] == [("epsilon", "150.0")]
    psv.write_rounded(one, f"{tmp_path}/r", {"value": 2})
    assert psv.read_rows(spark, f"{tmp_path}/r", ["a", "b"]).first().b == "150.00"
    assert psv.read_psv(spark, f"{tmp_path}/none*.psv", "a string", optional=True).count() == 0
    pts = spark.createDataFrame([(i, float(i), float(i % 7)) for i in range(100)], "siteId long, xx double, yy double")
    psv.write_grid(pts, f"{tmp_path}/g", 10.0)
    box = psv.read_box(spark, f"{tmp_path}/g", 10.0, 15.0, 2.0, 42.0, 3.0)
    assert {r.siteId for r in box.collect()} == {i for i in range(15, 43) if 2 <= i % 7 <= 3}
    assert psv.show(pts, 1) == "siteId|xx|yy\n0|0.0|0.0"
    psv.write_graph(pts, pts, f"{tmp_path}/graph")
    assert [x.count() for x in psv.read_graph(spark, f"{tmp_path}/graph")] == [100, 100]
    psv.delete_outputs(spark, str(tmp_path), ["g", "never"])
    assert not (tmp_path / "g").exists() and psv.attribute_columns(pts) == ["xx", "yy"]
    assert shared_dir(spark)


def test_repeated_osm_elements_count_once_and_the_first_wins(spark, tmp_path):
    node = '{{"type":"node","id":1,"lon":{},"lat":2.0}}'
    (tmp_path / "a.json").write_text('{"elements":[%s,%s]}' % (node.format(1.0), node.format(5.0)))
    (tmp_path / "b.json").write_text('{"elements":[%s]}' % node.format(9.0))
    assert [x.lon for x in psv.read_osm(spark, f"{tmp_path}/*.json")[0].collect()] == [1.0]


def test_percentiles_are_exact(spark):
    r = np.random.default_rng(2)
    values = np.concatenate([r.exponential(3, 3000), np.full(2500, 1.5), [1e9, -1e9]])
    frame = spark.createDataFrame([(float(v), float(k), None) for k, v in enumerate(values)], "a double, b double, c double")
    got = ranking.percentiles(frame, {"x": ("a", 0.2), "y": ("a", 0.9), "z": ("b", 0.333), "w": ("a", 1.0), "none": ("c", 0.5)}, buckets=16)
    assert got["none"] is None
    for name, (c, p) in {"x": (values, 0.2), "y": (values, 0.9), "z": (np.arange(len(values)), 0.333), "w": (values, 1.0)}.items():
        assert np.isclose(got[name], np.quantile(c, p), rtol=1e-12)


def test_a_missing_key_is_an_error(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "n long, v string"), spark.createDataFrame([(1, 9)], "n long, label long")
    assert zones.checked_join(a.where("n = 1"), b, "n").count() == 1
    with pytest.raises(ValueError):
        clusters.join_labels(a, b)


def test_clustering_from_end_to_end(spark):
    """Merges name only rows before them, sizes add up, and labels are those of the cut of the same merges."""
    r = random.Random(3)
    pts = [(i, 0, r.randrange(600), r.randrange(600), r.random(), r.random()) for i in range(60)] + [(60, 0, 5000, 5000, 0.5, 0.5)]
    frame = spark.createDataFrame(pts, "siteId long, town int, xx long, yy long, u double, v double")
    pairs = zones.box_pairs(frame, 150).where("a < b").select("a", "b", F.bround("d", 0).alias("d"))
    merges, labels = clusters.smpc(frame, pairs, ["u", "v"], 150.0, 0.4, 9)
    rows = merges.orderBy("seq").collect()
    assert [x.seq for x in rows] == list(range(len(rows))) and all(x.cid0 == "0" for x in rows[:61])
    size, members, whole = {}, {}, set()
    for x in rows[:61]:
        size[x.mcid], members[x.mcid] = 1, {int(x.mcid)}
        whole.add(x.mcid)
    for x in rows[61:]:
        assert x["size"] == size[x.cid0] + size[x.cid1]
        size[x.mcid], members[x.mcid] = x["size"], members[x.cid0] | members[x.cid1]
        if {x.cid0, x.cid1} <= whole and x.d < 0.4 and x["size"] <= 9:
            whole = whole - {x.cid0, x.cid1} | {x.mcid}
    want = {min(members[k]): members[k] for k in whole}
    rank = {n: k + 1 for k, low in enumerate(sorted(want)) for n in want[low]}
    assert {x.n: x.label for x in labels.collect()} == rank and 1 < len(want) < 61


def test_two_phases_and_least_sizes(spark):
    """Density clusters by brute force; a large one is split within itself, small merges are forced under `least`."""
    r = random.Random(6)
    pts = [(i, r.random() * 100, r.random() * 100) for i in range(30)] + [(30 + i, 1000 + r.random() * 40, r.random() * 40) for i in range(6)] + [(36, 9000.0, 0.0)]
    near = [(a, b) for a, x, y in pts for b, u, v in pts if a != b and (x - u) ** 2 + (y - v) ** 2 <= 60**2]
    frame = spark.createDataFrame([(i, x / 100, y / 100) for i, x, y in pts], "n long, u double, v double")
    pairs = spark.createDataFrame(near, "n0 long, n1 long")
    got = {x.n: (x.label, x.sub) for x in clusters.two_phase(frame, pairs, pairs.where("n0 < n1"), ["u", "v"], large=20).collect()}
    low, core = {i: i for i, *_ in pts}, {a for a, *_ in pts if sum(x == a for x, _ in near) >= 2}
    for _ in range(40):
        for a, b in near:
            if a in core and b in core:
                low[a] = low[b] = min(low[a], low[b])
    want = {i: low[i] if i in core else min((low[b] for a, b in near if a == i and b in core), default=-1) for i, *_ in pts}
    assert {n: a for n, (a, _) in got.items()} == want and want[36] == -1
    assert all(sub == label for label, sub in got.values() if label != want[0])
    assert all(want[sub] == label for label, sub in got.values() if label == want[0])
    tree = clusters.ward_tree(list(range(4)), np.array([[0.0], [5.0], [5.1], [9.0]]), [(0, 1), (1, 2), (2, 3)])
    assert clusters.cut_tree(4, tree, 0.5, 100, 0, inclusive=False) == [0, 1, 1, 3]
    assert clusters.cut_tree(4, tree, 0.5, 100, 2, inclusive=False) == [0, 0, 0, 0]


def brute_close(own, r, disc):
    off = [(i, j) for i in range(-r, r + 1) for j in range(-r, r + 1) if not disc or i * i + j * j <= r * r]
    grown = {(x + i, y + j) for x, y in own for i, j in off}
    return own | {c for c in grown if all((c[0] + i, c[1] + j) in grown for i, j in off)}


def brute_parts(own):
    left, n = set(own), 0
    while left:
        todo, n = [left.pop()], n + 1
        while todo:
            x, y = todo.pop()
            for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if c in left:
                    left.remove(c)
                    todo.append(c)
    return n


@pytest.mark.parametrize("disc", [False, True])
def test_merges_against_brute_force(spark, disc):
    """Growing closings of a label until it is one part, the radius at most the last."""
    r = random.Random(8)
    own = {k: {(r.randrange(4 + 5 * k), r.randrange(9)) for _ in range(10)} for k in range(4)}
    frame = spark.createDataFrame([(k, x, y) for k, s in own.items() for x, y in s], "label long, cx long, cy long")
    want = set()
    for k, s in own.items():
        for radius in (1, 2, 3):
            done = brute_close(s, radius, disc)
            if brute_parts(done) == 1:
                break
        want |= {(k, x, y) for x, y in done}
    assert {tuple(x) for x in cells.merge(frame, 1, 1, 3, disc=disc).collect()} == want
    if not disc:
        both = areas.merged_or_round(frame, 1, 1, 2, 1)
        assert both.select("label").distinct().count() == 4 and frame.join(both, cells.KEYS, "left_anti").isEmpty()


def test_site_distances_against_dijkstra(spark):
    """A lattice with sites on its edges: both ends, the override on one edge, string order of ids."""
    import heapq

    r = random.Random(9)
    at = {i: (i % 4 * 100.0, i // 4 * 100.0) for i in range(16)}
    edges = [(f"{a}-{b}", a, b, 100.0 / r.choice([0.5, 1.0, 1.5])) for a in at for b in at if a < b and abs(at[a][0] - at[b][0]) + abs(at[a][1] - at[b][1]) == 100]
    sites = [(str(k), *r.choice(edges)[:1], r.uniform(0, 100), 100.0) for k in range(14)]
    near = {}
    for _, a, b, t in edges:
        near.setdefault(a, []).append((b, t))
        near.setdefault(b, []).append((a, t))
    ends = {e: (a, b) for e, a, b, _ in edges}
    want = {}
    for s, seg, along, long in sites:
        for start, part in zip(ends[seg], (along, long - along)):
            best, heap = {}, [(0.0, start)]
            while heap:
                d, n = heapq.heappop(heap)
                if n in best or d > 250:
                    continue
                best[n] = d
                for m, t in near[n]:
                    heapq.heappush(heap, (d + t, m))
            for t, seg1, along1, long1 in sites:
                if t != s and seg1 != seg:
                    for end, part1 in zip(ends[seg1], (along1, long1 - along1)):
                        if end in best:
                            key = min(s, t), max(s, t)
                            want[key] = min(want.get(key, 1e9), part + best[end] + part1)
        for t, seg1, along1, _ in sites:
            if seg1 == seg and s <= t:
                want[s, t] = abs(along - along1)
    got = network.site_distances(spark.createDataFrame(sites, "siteId string, segId string, along double, len double"), spark.createDataFrame(edges, "segId string, a long, b long, time double"), 250.0)
    rows = {(x.siteId0, x.siteId1): x.distance for x in got.collect()}
    assert rows.keys() == want.keys() and all(abs(rows[k] - want[k]) < 1e-9 for k in want)
