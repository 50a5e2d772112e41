"""Scalar expressions of the zone pipeline."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Road classes that count as roads.
ROAD_CLASSES = (
    "motorway",
    "motorway_junction",
    "motorway_link",
    "primary",
    "primary_link",
    "residential",
    "secondary",
    "secondary_link",
    "service",
    "tertiary",
    "tertiary_link",
    "trunk",
    "trunk_link",
    "turning_circle",
    "unclassified",
)
#: Industry codes that a restaurant type forces.
RESTAURANT_CODES = {"Fast Food": "722513", "Coffee/Drinks": "722515", "Casual": "722511"}
UNKNOWN_CATEGORY = "99-999-999"
KERNEL_SIGMA = 200.0


def address_key(*cols: str) -> Column:
    return F.concat_ws(", ", *(F.coalesce(F.col(c), F.lit("")) for c in cols))


def both_or(lon: str, lat: str, geo_lon: str, geo_lat: str) -> tuple[Column, Column]:
    """The geocoded pair where both are there, else the original pair."""
    there = F.col(geo_lon).isNotNull() & F.col(geo_lat).isNotNull()
    return F.when(there, F.col(geo_lon)).otherwise(F.col(lon)), F.when(there, F.col(geo_lat)).otherwise(F.col(lat))


def forced_code(res_type: Column, code: Column) -> Column:
    out = code
    for k, v in RESTAURANT_CODES.items():
        out = F.when(res_type == k, v).otherwise(out)
    return out


def speed(road_class: Column) -> Column:
    return F.when(road_class.isin("primary", "secondary"), 1.5).when(road_class == "residential", 0.5).otherwise(1.0)


def kernel(distance: Column, sigma: float = KERNEL_SIGMA) -> Column:
    return F.exp(-(distance * distance) / (2 * sigma * sigma))


def pair_key(a: Column, b: Column) -> tuple[Column, Column]:
    """An unordered pair of ids in string order."""
    a, b = a.cast("string"), b.cast("string")
    return F.least(a, b), F.greatest(a, b)


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1))


def clipped_line(v: Column, low: Column, high: Column, at_low: float = 0.2, at_high: float = 1.0) -> Column:
    """Linear from at_low at `low` to at_high at `high`, clipped; NaN where low = high."""
    line = at_low + (at_high - at_low) * (v - low) / F.nullif(high - low, F.lit(0.0))
    return F.when(high == low, F.lit(float("nan"))).otherwise(F.least(F.greatest(line, F.lit(at_low)), F.lit(at_high)))


def saturating(v: Column, f: Column) -> Column:
    """1 - exp(-v / f); for f = 0: 1 where v > 0, else NaN."""
    return F.when(f == 0, F.when(v > 0, 1.0).otherwise(float("nan"))).otherwise(1 - F.exp(-v / F.nullif(f, F.lit(0.0))))


def segment_place(px: Column, py: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> tuple[Column, Column]:
    """(distance of a point to a segment, share of the segment at the nearest place)."""
    dx, dy = x1 - x0, y1 - y0
    long = dx * dx + dy * dy
    t = F.when(long == 0, 0.0).otherwise(F.least(F.greatest(((px - x0) * dx + (py - y0) * dy) / F.nullif(long, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)))
    return distance(px, py, x0 + t * dx, y0 + t * dy), t
