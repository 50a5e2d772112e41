import heapq
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.functions.projection import TransverseMercator
from mercato.operators import cells, clusters, network
from mercato.plans.queries import ORACLES, QUERIES
from mercato.sources import psv

SF = "/root/testdata/sf0.001"
QUICK = ["io2_last_wins", "p1_project", "f2_geocode_limit", "j3_classify_left", "j9_snap_nearest", "g4_kernel_density", "g20_last_edge", "p15_density_factor", "m1_delaunay", "pg1_closing"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF)
    c = duckdb.connect()
    for t in ("customer", "part", "supplier"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    r = c.execute(ORACLES[name])
    at = {x[0]: i for i, x in enumerate(r.description)}
    cols = sorted(got.columns)
    assert sorted(at) == cols
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(x) for x in got.select(*cols).collect()) == key(tuple(x[at[n]] for n in cols) for x in r.fetchall())


def test_projection_round_trip(spark):
    pts = [(-122.63 + i / 50, 47.09 + j / 50) for i in range(20) for j in range(12)]
    tm = TransverseMercator()
    x, y = tm.forward(F.col("lon"), F.col("lat"))
    df = spark.createDataFrame(pts, "lon double, lat double").select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = tm.inverse(F.col("x"), F.col("y"))
    worst = df.select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-6


def test_bounded_paths_against_dijkstra(spark):
    r = random.Random(2)
    edges = [(a, b, float(r.randrange(50, 400))) for a in range(40) for b in r.sample(range(40), 3) if a < b]
    near = {}
    for a, b, t in edges:
        near.setdefault(a, []).append((b, t))
        near.setdefault(b, []).append((a, t))
    want = {}
    for s in (0, 7, 21):
        best, heap = {}, [(0.0, s)]
        while heap:
            d, n = heapq.heappop(heap)
            if n in best or d > 700:
                continue
            best[n] = d
            for m, t in near.get(n, []):
                heapq.heappush(heap, (d + t, m))
        want |= {(s, n): d for n, d in best.items()}
    got = network.bounded_paths(spark.createDataFrame(edges, "a long, b long, time double"), spark.createDataFrame([(0,), (7,), (21,)], "node long"), 700.0)
    assert {(x.src, x.node): x.time for x in got.collect()} == want


def test_ward_and_cut():
    values = np.array([[0.0], [0.1], [1.0], [1.1], [5.0]])
    tree = clusters.ward_tree(list(range(5)), values, [(0, 1), (1, 2), (2, 3), (3, 4)])
    assert [t[:2] for t in tree[:2]] == [(0, 1), (2, 3)] or [t[:2] for t in tree[:2]] == [(2, 3), (0, 1)]
    assert clusters.cut_tree(5, tree, 1.8, 300) == [0, 0, 0, 0, 4]
    assert clusters.cut_tree(5, tree, 1.8, 2) == [0, 0, 2, 2, 4]
    assert clusters.cut_tree(5, tree, 0.01, 2) == [0, 1, 2, 3, 4]


def test_resolve_overlaps(spark):
    sq = lambda label, x, n: [(label, i, j) for i in range(x, x + n) for j in range(n)]
    rows = sq(1, 0, 10) + sq(2, 8, 6) + sq(3, 100, 5) + sq(4, 101, 3)
    got = {}
    for k, x, y in cells.resolve(spark.createDataFrame(rows, "label long, cx long, cy long")).collect():
        got.setdefault(k, set()).add((x, y))
    assert len(got[1]) == 100 - 12 and len(got[2]) == 36 and len(got[3]) == 25 and 4 not in got


def test_psv(spark, tmp_path):
    (tmp_path / "a.psv").write_text('pid|name|chainid\n1|"Joe ""X"" Bar"|\n2|b|7\n')
    got = psv.read_psv(spark, str(tmp_path / "a.psv"), "pid string, name string, chainid string").collect()
    assert [tuple(x) for x in got] == [("1", 'Joe "X" Bar', None), ("2", "b", "7")]
    assert psv.read_psv(spark, str(tmp_path / "none.psv"), "a string", optional=True).count() == 0


def test_osm(spark, tmp_path):
    (tmp_path / "r1.json").write_text('{"elements":[{"type":"node","id":1,"lon":1.0,"lat":2.0},{"type":"way","id":9,"nodes":[1,2],"tags":{"highway":"primary","oneway":"yes"}}]}')
    (tmp_path / "r2.json").write_text("not json")
    nodes, ways = psv.read_osm(spark, f"{tmp_path}/r*.json")
    assert nodes.count() == 1 and [tuple(x) for x in ways.collect()] == [(9, "primary", True, [1, 2])]


def test_nearest_in_thin_areas(spark):
    r = random.Random(6)
    pts = [(i, r.randrange(100), r.randrange(100)) for i in range(20)] + [(20 + i, 3000 * (i + 1), 700 * i) for i in range(6)]
    want = {(a, b, k + 1) for a, x, y in pts for k, (_, b) in enumerate(sorted(((x - u) ** 2 + (y - v) ** 2, b) for b, u, v in pts if b != a)[:4])}
    frame = spark.createDataFrame(pts, "siteId long, xx long, yy long")
    assert {(x.a, x.b, x.rank) for x in clusters.nearest(frame, 4, 400.0).collect()} == want
    few = clusters.nearest(frame.where("siteId >= 23"), 4, 400.0).collect()
    assert len(few) == 6 and clusters.nearest(frame.limit(0), 4, 400.0).count() == 0


def test_round_limits_are_errors(spark):
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(5)], "a long, b long, time double")
    with pytest.raises(RuntimeError):
        network.bounded_paths(edges, spark.createDataFrame([(0,)], "node long"), 700.0, max_rounds=3)
    with pytest.raises(RuntimeError):
        clusters.connected_components(edges, "a", "b", max_rounds=1)
