"""Row numbers within groups, where a group may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def rank_in_group(df: DataFrame, group: str, bucket: str, order: list[str | Column], name: str = "rank") -> DataFrame:
    """df with `name`: 0, 1, .. within `group`, gapless.

    `bucket` splits each group (it must be a fixed column, not recomputed): rows are
    numbered within (group, bucket), and a prefix sum over the bucket counts gives each
    bucket its base. The counts are broadcast, so groups times buckets must be bounded.
    """
    counts = df.groupBy(group, bucket).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(group, bucket, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    own = F.row_number().over(Window.partitionBy(group, bucket).orderBy(*order)) - 1
    return df.withColumn("__own", own).join(F.broadcast(base), [group, bucket]).withColumn(name, (F.col("__base") + F.col("__own")).cast("long")).drop("__own", "__base")


def sequential_ids(df: DataFrame, order: str, name: str = "seq", buckets: int = 1024, then: tuple[str, ...] = ()) -> DataFrame:
    """df with 0, 1, .. in the order of an integer column, without sorting all rows in one task.

    Values are cut into equal ranges; ties stand in the order of `then`, else in any.
    """
    low, high = df.agg(F.min(order), F.max(order)).first()
    if low is None:
        return df.withColumn(name, F.lit(0).cast("long"))
    width = (high - low) // buckets + 1
    df = df.withColumns({"__g": F.lit(0), "__b": F.floor((F.col(order) - low) / width)})
    return rank_in_group(df, "__g", "__b", [order, *then], name).drop("__g", "__b")


def percentiles(df: DataFrame, wanted: dict[str, tuple[str, float]], buckets: int = 4096) -> dict[str, float | None]:
    """Exact linearly interpolated percentiles, name -> (column, share), nulls left out; None for no values.

    Each pass over the rows serves all columns: it counts the values in equal ranges of
    those that hold the wanted ranks, which are cut again where they hold many rows, so no
    task gets all values. A last pass sorts what is in them. Equal values in a range are
    counted, not gathered. The driver gets at most `buckets` rows a range.
    """
    cols = sorted({c for c, _ in wanted.values()})
    ends = df.agg(*(f(F.col(c).cast("double")).alias(f"{c}{k}") for c in cols for k, f in enumerate((F.min, F.max, F.count)))).first()
    low, high, n = ({c: ends[f"{c}{k}"] for c in cols} for k in range(3))
    at = {name: share * (n[c] - 1) for name, (c, share) in wanted.items() if n[c]}
    ranks = {name: (int(x), min(int(x) + 1, n[wanted[name][0]] - 1)) for name, x in at.items()}
    #: (column, rank): the range that holds it, the rows before the range and in it
    held = {(wanted[name][0], r): (low[wanted[name][0]], high[wanted[name][0]], 0, n[wanted[name][0]]) for name in at for r in ranks[name]}

    def counted(keys: list, place) -> dict:
        """By (column, range): the rows (p, n, a, b), ascending by p."""
        ranges = sorted({(c, *held[c, r][:2]) for c, r in keys})
        if not ranges:
            return {}
        value = {c: F.col(c).cast("double") for c in cols}
        spots = (F.when(value[c].between(a, b), F.struct(F.lit(i).alias("i"), place(value[c], a, b).cast("double").alias("p"), value[c].alias("v"))) for i, (c, a, b) in enumerate(ranges))
        spots = df.select(F.explode(F.array(*spots)).alias("s")).where("s is not null").select("s.*")
        out: dict = {x: [] for x in ranges}
        for row in spots.groupBy("i", "p").agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect():
            out[ranges[row["i"]]].append(row)
        return {x: sorted(rows, key=lambda row: row["p"]) for x, rows in out.items()}

    def step(keys: list, place) -> None:
        rows = counted(keys, place)
        for c, rank in keys:
            a, b, before, _ = held[c, rank]
            for row in rows[c, a, b]:
                if before + row["n"] > rank:
                    break
                before += row["n"]
            held[c, rank] = row["a"], row["b"], before, row["n"]

    while wide := [k for k, (a, b, _, many) in held.items() if many > buckets and b > a]:
        step(wide, lambda v, a, b: F.least(F.floor((v - a) / ((b - a) / buckets)), F.lit(buckets - 1)))
    step([k for k, (a, b, *_) in held.items() if b > a], lambda v, a, b: v)  # at most `buckets` values
    out: dict[str, float | None] = dict.fromkeys(wanted)
    for name, x in at.items():
        first, last = (held[wanted[name][0], r][0] for r in ranks[name])
        out[name] = first + (last - first) * (x - int(x))
    return out
