import random

from mercato.operators.components import connected_components


def test_chain_star_and_ties(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(5000, 5001), (5001, 5000), (7, 7), (None, 3)]
    r.shuffle(edges)
    got = dict(connected_components(spark.createDataFrame(edges, "src long, dst long")).collect())
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)} | {5000: 5000, 5001: 5000}
    assert got == want


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
