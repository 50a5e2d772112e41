"""Businesses to sites, densities and attributes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from mercato.functions.scalars import KERNEL_SIGMA, UNKNOWN_CATEGORY, clipped_line, distance, forced_code, kernel, saturating
from mercato.operators.grid import cell, grid_join
from mercato.operators.ranking import percentiles, sequential_ids


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the one with the greatest `order`."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def geocoded(biz: DataFrame, geocode: DataFrame, limit: float = 50.0) -> DataFrame:
    """biz with gx, gy of its address where the move is under `limit` metres (strict), else null."""
    g = geocode.select(F.col("key").alias("__key"), F.col("x").alias("__x"), F.col("y").alias("__y"))
    j = biz.join(g, biz["key"] == g["__key"], "left")
    ok = distance(F.col("xx"), F.col("yy"), F.col("__x"), F.col("__y")) < limit
    return j.withColumns({"gx": F.when(ok, F.col("__x")), "gy": F.when(ok, F.col("__y"))}).drop("__key", "__x", "__y")


def classify(biz: DataFrame, sic_codes: DataFrame, categories: DataFrame) -> DataFrame:
    """biz with code, bcid, bc1: unknown industries get code 0, unknown codes the unknown category."""
    j = biz.join(sic_codes, "psic", "left").withColumn("code", forced_code(F.col("res_type"), F.coalesce("naics", F.lit("0")))).drop("naics")
    j = j.join(categories, "code", "left")
    return j.withColumns({"bcid": F.coalesce("bcid", F.lit(UNKNOWN_CATEGORY)), "bc1": F.coalesce("bc1", F.lit("Unknown"))})


def sites(biz: DataFrame) -> DataFrame:
    """(siteId, xx, yy, first_pid, n): businesses grouped by rounded coordinates, ids in order of the first business."""
    g = biz.groupBy(F.bround("xx").alias("rx"), F.bround("yy").alias("ry")).agg(F.min("k").alias("k0"), F.min_by(F.struct("xx", "yy", "pid", "town"), "k").alias("f"), F.count("*").alias("n"))
    g = sequential_ids(g, "k0")
    return g.select((F.col("seq") + 1).cast("string").alias("siteId"), "f.xx", "f.yy", F.col("f.pid").alias("first_pid"), "f.town", "n", "rx", "ry")


def site_list(biz: DataFrame) -> DataFrame:
    """sites with the first business's own lon and lat, though x and y may come from a geocode, and all ids in their order."""
    g = biz.groupBy(F.bround("xx").alias("rx"), F.bround("yy").alias("ry")).agg(F.min("k").alias("k0"), F.min_by(F.struct("lon", "lat", "xx", "yy"), "k").alias("f"), F.sort_array(F.collect_list(F.struct("k", "pid"))).alias("ids"))
    g = sequential_ids(g, "k0")
    return g.select((F.col("seq") + 1).cast("string").alias("siteId"), "f.*", F.transform("ids", lambda s: s["pid"]).alias("bizIds"))


def checked_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """An inner join in which a row of the left without a partner is an error."""
    lost = left.join(right.select(on), on, "left_anti").select(on).first()
    if lost is not None:
        raise ValueError(f"no {on} {lost[0]!r} in the table looked up")
    return left.join(right, on)


def site_lookup(biz: DataFrame, found: DataFrame) -> DataFrame:
    return biz.withColumns({"rx": F.bround("xx"), "ry": F.bround("yy")}).join(found.select("siteId", "rx", "ry"), ["rx", "ry"]).select("siteId", F.col("pid").alias("bizId"))


def box_pairs(points: DataFrame, radius: float, ident: str = "siteId", x: str = "xx", y: str = "yy") -> DataFrame:
    """(a, b, d): ordered pairs within the box of +-radius, self pairs included, with their distance."""
    a = points.select(F.col(ident).alias("a"), F.col(x).cast("double").alias("ax"), F.col(y).cast("double").alias("ay"))
    b = points.select(F.col(ident).alias("b"), F.col(x).cast("double").alias("bx"), F.col(y).cast("double").alias("by"))
    return grid_join(a, b, radius, "ax", "ay", "bx", "by").select("a", "b", distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")).alias("d"))


def density(points: DataFrame, cutoff: float = 600.0) -> DataFrame:
    """(siteId, density): Gaussian kernel sums over sites nearer than cutoff, itself once."""
    p = box_pairs(points, cutoff).where(F.col("d") < cutoff)
    return p.groupBy(F.col("a").alias("siteId")).agg(F.sum(kernel(F.col("d"))).alias("density"))


def pair_density(sites: DataFrame, pairs: DataFrame, cutoff: float = 600.0) -> DataFrame:
    """(siteId, density, density_r1): kernel sums over the pair table, each site itself once; sites without a pair have 0.

    pairs: siteId0, siteId1, distance, unordered, with or without self pairs. density_r1 has
    one decimal, as stored between stages; factors take the unrounded one.
    """
    near = pairs.where(F.col("distance") < cutoff).withColumn("k", kernel(F.col("distance")))
    both = near.select(F.col("siteId0").alias("siteId"), "k").unionByName(near.where("siteId0 <> siteId1").select(F.col("siteId1").alias("siteId"), "k"))
    return with_zero(sites, both.groupBy("siteId").agg(F.sum("k").alias("density")))


def kernel_weights(d: np.ndarray) -> np.ndarray:
    """kernel of numpy arrays."""
    return np.exp(-(d * d) / (2 * KERNEL_SIGMA * KERNEL_SIGMA))


def with_zero(sites: DataFrame, sums: DataFrame) -> DataFrame:
    """(siteId, density, density_r1) of all sites from the sums of some; the others have 0."""
    out = sites.select("siteId").join(sums, "siteId", "left").withColumn("density", F.coalesce("density", F.lit(0.0)))
    return out.withColumn("density_r1", F.bround("density", 1))


def ba_distances(pairs: DataFrame, ba_sites: DataFrame, box: float = 400.0) -> DataFrame:
    """(siteId0, siteId1, distance): pairs of ba sites within the box, in both orders, self pairs once, distance without decimals.

    It starts from the pair table, which is sparser than the box.
    """
    at = lambda n: ba_sites.select(F.col("siteId").alias(f"siteId{n}"), F.col("xx").alias(f"x{n}"), F.col("yy").alias(f"y{n}"))
    j = pairs.join(at(0), "siteId0").join(at(1), "siteId1").where((F.abs(F.col("x0") - F.col("x1")) <= box) & (F.abs(F.col("y0") - F.col("y1")) <= box))
    return both_orders(j.select("siteId0", "siteId1", F.bround("distance", 0).alias("distance")))


def both_orders(pairs: DataFrame) -> DataFrame:
    """Unordered pairs in both orders, self pairs once; the pairs are made only once."""
    ways = F.array(F.struct("siteId0", "siteId1"), F.struct(F.col("siteId1").alias("siteId0"), F.col("siteId0").alias("siteId1")))
    way = F.explode(F.when(F.col("siteId0") == F.col("siteId1"), F.slice(ways, 1, 1)).otherwise(ways))
    return pairs.select(way.alias("way"), "distance").select("way.siteId0", "way.siteId1", "distance")


def with_density(ba_sites: DataFrame, dense: DataFrame) -> DataFrame:
    """ba sites with the stored density of theirs as an attribute."""
    return ba_sites.join(dense.select("siteId", F.col("density_r1").alias("density")), "siteId")


def attribute(biz: DataFrame, pairs: DataFrame, name: str, predicate: Column, weight=kernel, cutoff: float = 500.0) -> DataFrame:
    """(siteId, name): one attribute from businesses (siteId, ..) that a predicate keeps and a weight of the distance.

    pairs as in attributes: both directions are taken, so a site counts twice for itself.
    """
    counts = biz.where(predicate).groupBy("siteId").agg(F.count("*").alias("n"))
    near = pairs.where(F.col("d") < cutoff)
    both = near.select(F.col("siteId0").alias("to"), F.col("siteId1").alias("siteId"), "d").unionByName(near.select(F.col("siteId1").alias("to"), F.col("siteId0").alias("siteId"), "d"))
    return both.join(counts, "siteId").groupBy(F.col("to").alias("siteId")).agg(F.sum(F.col("n") * weight(F.col("d"))).alias(name))


def of_known_sites(rows: DataFrame, sites: DataFrame) -> DataFrame:
    return rows.join(sites.select("siteId"), "siteId", "left_semi")


def labels_around(points: DataFrame, labelled: DataFrame, margin: float = 1000.0) -> DataFrame:
    """(label, siteId, xx, yy): points within the box of each label's points, widened by a margin."""
    box = labelled.groupBy("label").agg(F.min("xx").alias("x0"), F.max("xx").alias("x1"), F.min("yy").alias("y0"), F.max("yy").alias("y1"))
    span = lambda a, b: F.sequence(cell(F.col(a) - margin, margin), cell(F.col(b) + margin, margin))
    own = box.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1")))
    at = points.select("siteId", "xx", "yy", cell(F.col("xx"), margin).alias("cx"), cell(F.col("yy"), margin).alias("cy"))
    inside = F.col("xx").between(F.col("x0") - margin, F.col("x1") + margin) & F.col("yy").between(F.col("y0") - margin, F.col("y1") + margin)
    return own.join(at, ["cx", "cy"]).where(inside).select("label", "siteId", "xx", "yy")


def density_factor(dense: DataFrame) -> DataFrame:
    """dense with factor: density between its 20th and 80th percentile rescaled to 0.2 .. 1."""
    p = percentiles(dense, {"lo": ("density", 0.2), "hi": ("density", 0.8)})
    return dense.withColumn("factor", clipped_line(F.col("density"), F.lit(p["lo"]), F.lit(p["hi"])))


def attributes(flags: DataFrame, pairs: DataFrame, names: list[str], cutoff: float = 500.0) -> DataFrame:
    """(siteId, one sum a name): kernel-weighted counts of flagged businesses at sites nearer than cutoff.

    flags: siteId with a count per name. pairs: (siteId0, siteId1, d), unordered with self
    pairs; both directions are taken, so a site counts twice for itself. One pass for all
    names.
    """
    near = pairs.where(F.col("d") < cutoff)
    both = near.select(F.col("siteId0").alias("to"), F.col("siteId1").alias("siteId"), "d").unionByName(near.select(F.col("siteId1").alias("to"), F.col("siteId0").alias("siteId"), "d"))
    return both.join(flags, "siteId").groupBy(F.col("to").alias("siteId")).agg(*(F.sum(F.col(n) * kernel(F.col("d"))).alias(n) for n in names))


def box_attributes(points: DataFrame, flags: DataFrame, names: list[str], box: float = 400.0, cutoff: float = 500.0, sigma: float = KERNEL_SIGMA) -> DataFrame:
    """attributes over the site pairs of the +-box, from the points (siteId, xx, yy) themselves: no pair is written or sent.

    Points meet the flagged ones of the nine cells around, cell by cell, in blocks of rows.
    """
    place = [F.col("siteId"), F.col("xx").cast("double").alias("x"), F.col("yy").cast("double").alias("y")]
    own = points.select(*place, cell(F.col("xx").cast("double"), box).alias("cx"), cell(F.col("yy").cast("double"), box).alias("cy"))
    near = F.array(*(F.lit(k) for k in (-1, 0, 1)))
    other = own.join(flags.select("siteId", *(F.col(n).cast("double").alias(n) for n in names)), "siteId").withColumn("i", F.explode(near)).withColumn("j", F.explode(near))
    # renamed throughout: Spark can't tell the columns of two frames of one origin apart
    other = other.select(F.col("siteId").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), *(F.col(n).alias(f"n_{n}") for n in names), (F.col("cx") + F.col("i")).alias("bcx"), (F.col("cy") + F.col("j")).alias("bcy"))

    def work(p: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(p) or not len(q):
            return pd.DataFrame({"siteId": p["siteId"][:0], **{n: [] for n in names}})
        values, at, x, y = q[[f"n_{n}" for n in names]].to_numpy(float), {k: i for i, k in enumerate(q["b"])}, q["bx"].to_numpy(), q["by"].to_numpy()
        sums, met = np.zeros((len(p), len(names))), np.zeros(len(p), bool)
        step = max(1, (1 << 21) // len(q))
        for k in range(0, len(p), step):
            dx, dy = (p[c].to_numpy()[k : k + step, None] - v for c, v in (("x", x), ("y", y)))
            d = np.sqrt(dx * dx + dy * dy)
            ok = (d < cutoff) & (np.abs(dx) <= box) & (np.abs(dy) <= box)
            weight = np.where(ok, np.exp(-(d * d) / (2 * sigma * sigma)), 0.0)
            sums[k : k + step], met[k : k + step] = weight @ values, ok.any(1)
        mine = np.array([at.get(n, -1) for n in p["siteId"]])
        sums[mine >= 0] += values[mine[mine >= 0]]  # a site counts twice for itself
        return pd.DataFrame({"siteId": p["siteId"], **dict(zip(names, sums.T))})[met]

    return own.groupBy("cx", "cy").cogroup(other.groupBy("bcx", "bcy")).applyInPandas(work, "siteId string, " + ", ".join(f"{n} double" for n in names))


def rescaled(sums: DataFrame, names: list[str]) -> DataFrame:
    """Each attribute as 1 - exp(-v / its 90th percentile)."""
    p = percentiles(sums, {n: (n, 0.9) for n in names})
    return sums.select("siteId", *(saturating(F.col(n), F.lit(p[n])).alias(n) for n in names))


def scaled_distances(pairs: DataFrame, factors: DataFrame) -> DataFrame:
    """pairs with distance times the larger of both sites' factors."""
    f = factors.select("siteId", "factor")
    f0 = f.withColumnsRenamed({"siteId": "siteId0", "factor": "f0"})
    f1 = f.withColumnsRenamed({"siteId": "siteId1", "factor": "f1"})
    return pairs.join(f0, "siteId0").join(f1, "siteId1").select("siteId0", "siteId1", (F.greatest("f0", "f1") * F.col("d")).alias("d"))


def scaled_box_pairs(points: DataFrame, factors: DataFrame, box: float) -> DataFrame:
    """scaled_distances of the unordered pairs of the +-box, self pairs included; the factors travel with the points, so no pair is sent."""
    p = points.join(factors.select("siteId", "factor"), "siteId")
    a, b = (p.select(F.col("siteId").alias(k), F.col("xx").cast("double").alias(f"{k}x"), F.col("yy").cast("double").alias(f"{k}y"), F.col("factor").alias(f"{k}f")) for k in "ab")
    d = F.greatest("af", "bf") * distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    return grid_join(a, b, box, "ax", "ay", "bx", "by").where("a <= b").select(F.col("a").alias("siteId0"), F.col("b").alias("siteId1"), d.alias("d"))


def chain_flag(chainid: Column, strict: bool = False) -> Column:
    """Blank ids count as chains unless strict, as only the id 0 is excluded."""
    return chainid.isNotNull() & (chainid != "0") if strict else F.coalesce(chainid, F.lit("")) != "0"
