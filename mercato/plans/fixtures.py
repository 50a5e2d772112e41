"""Spatial tables derived from the driver's tables by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercato.session import table

FLAGS = ("adef", "blucol", "whtcol", "conv", "dest", "fsr", "lsr", "bar", "hotel", "artsy", "eds", "meds", "gov")
SIC = [("AUTOMOBILE", "441"), ("BUILDING", "236"), ("FURNITURE", "442"), ("HOUSEHOLD", "449")]
CATEGORIES = [("441", "01-001-001", "Retail"), ("236", "02-001-001", "Works"), ("442", "01-002-001", "Retail"), ("722513", "03-001-001", "Food"), ("722515", "03-001-002", "Food")]
SEMANTICS = [("01-001-001", 5), ("02-001-001", 6), ("01-002-001", 1371), ("03-001-001", 4097), ("03-001-002", 2731), ("99-999-999", 8)]
CLASSES = ("primary", "residential", "secondary", "service")


def biz(spark, d: str) -> DataFrame:
    """Businesses in 25 towns of 2 km; every tenth shares the place of the one before."""
    at = F.col("c_custkey") - F.when(F.col("c_custkey") % 10 == 9, 1).otherwise(0)
    base = table(spark, d, "customer").withColumn("at", at)
    town = F.col("town")
    # the place, town included, is that of the business it stands with
    homes = base.select(F.col("c_custkey").alias("at"), F.col("c_nationkey").cast("long").alias("town"))
    j = base.join(homes, "at")
    k = F.col("c_custkey")
    return j.select(
        k.alias("k"), k.cast("string").alias("pid"), F.col("c_name").alias("name"), town,
        ((town % 5) * 5000 + (F.col("at") * 7919) % 2003).alias("xx"), (F.floor(town / 5) * 5000 + (F.col("at") * 104729) % 1999).alias("yy"),
        F.col("c_mktsegment").alias("psic"), F.when(k % 7 != 1, (k % 7).cast("string")).alias("chainid"),
        F.when(k % 11 == 0, "Fast Food").when(k % 11 == 1, "Coffee/Drinks").when(k % 11 == 2, "Casual").alias("res_type"),
        F.when(k % 13 != 0, k.cast("string")).alias("address"), F.col("c_nationkey").cast("string").alias("city"),
    )


def lonlat(df: DataFrame) -> DataFrame:
    return df.withColumns({"lon": -122.63 + F.col("xx") / 75600, "lat": 47.09 + F.col("yy") / 111200})


def geocode(spark, d: str) -> DataFrame:
    """Found places of every third business, moved by 0 to 90 m; 50 m exactly is among the moves."""
    b = biz(spark, d).where("k % 3 = 0")
    return b.select(F.concat_ws(", ", F.coalesce("address", F.lit("")), "city").alias("key"), (F.col("xx") + (F.col("k") % 4) * 10).alias("x"), (F.col("yy") + (F.col("k") % 10) * 10).alias("y")).groupBy("key").agg(F.max("x").alias("x"), F.max("y").alias("y"))


def sic_codes(spark) -> DataFrame:
    return spark.createDataFrame(SIC, "psic string, naics string")


def categories(spark) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "code string, bcid string, bc1 string")


def semantics(spark) -> DataFrame:
    """bcid and its flags, '1' for true: bit j of a mask is flag j."""
    m = spark.createDataFrame(SEMANTICS, "bcid string, mask int")
    return m.select("bcid", *(F.shiftright("mask", j).bitwiseAND(F.lit(1)).cast("string").alias(f) for j, f in enumerate(FLAGS)))


def junctions(spark, d: str) -> DataFrame:
    """One lattice of roads a town: node, town, i, j, x, y, size."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("node"), (F.col("p_partkey") % 25).alias("town"), F.floor(F.col("p_partkey") / 25).alias("m"), F.col("p_size").alias("size"))
    w = p.groupBy("town").agg(F.ceil(F.sqrt(F.count("*"))).alias("w"))
    j = p.join(F.broadcast(w), "town").withColumns({"i": F.col("m") % F.col("w"), "j": F.floor(F.col("m") / F.col("w")), "sp": F.floor(2000 / F.col("w"))})
    return j.select("node", "town", "i", "j", ((F.col("town") % 5) * 5000 + F.col("i") * F.col("sp")).alias("x"), (F.floor(F.col("town") / 5) * 5000 + F.col("j") * F.col("sp")).alias("y"), "size", "w", "m", "sp")


def ways(spark, d: str) -> DataFrame:
    """Rows and columns of the lattices as ways: way, highway, nodes; every seventh has a class that isn't a road's."""
    n = junctions(spark, d)
    rows = n.select((F.col("town") * 1000 + F.col("j")).alias("way"), F.col("i").alias("at"), "node")
    cols = n.select((F.col("town") * 1000 + 500 + F.col("i")).alias("way"), F.col("j").alias("at"), "node")
    g = rows.unionByName(cols).groupBy("way").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "node"))), lambda s: s["node"]).alias("nodes"))
    kind = F.get(F.array(*map(F.lit, CLASSES)), (F.col("way") % 4).cast("int"))
    return g.select("way", F.when(F.col("way") % 7 == 0, "footway").otherwise(kind).alias("highway"), "nodes")


def edges(spark, d: str) -> DataFrame:
    """Lattice edges: segId, a, b, x0, y0, x1, y1, length, highway."""
    n = junctions(spark, d)
    to = n.select(F.col("town").alias("t2"), F.col("i").alias("i2"), F.col("j").alias("j2"), F.col("node").alias("b"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    nxt = n.withColumn("s", F.explode(F.array(F.lit(0), F.lit(1))))
    on = (F.col("town") == F.col("t2")) & (F.col("i") + 1 - F.col("s") == F.col("i2")) & (F.col("j") + F.col("s") == F.col("j2"))
    kind = F.get(F.array(*map(F.lit, CLASSES)), (F.col("size") % 4).cast("int"))
    return nxt.join(to, on).select(F.concat_ws("-", "node", "b").alias("segId"), F.col("node").alias("a"), "b", F.col("x").alias("x0"), F.col("y").alias("y0"), "x1", "y1", F.col("sp").cast("long").alias("length"), kind.alias("highway"), "town")


