"""SimHash document fingerprints in DataFrame operations alone.

Terms are runs of three words; a term's weight is the number of times it occurs. Each
term's 64-bit hash votes on each bit, and the signs of the sums are the fingerprint. Two
32-bit counters share one 64-bit sum, so 32 sums hold all votes (a text has fewer than
2^31 terms).

Fingerprints within a Hamming radius are found by permuted block tables: the 64 bits are
cut into `blocks` blocks, each table has another choice of blocks - radius of them in
front, and fingerprints within the radius agree on the front of at least one table.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.llm.text_sql import ASCII_SPACE, ahead, joined, words
from mercato.session import cut, table

LANES = 0x0000000100000001
#: Documents of one bucket of neighbours, and the most buckets: beyond 131 million documents buckets grow.
BUCKET_ROWS, MOST_BUCKETS = 2000, 65_536


def fingerprints(rows: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """keys, fp: keys must identify a row. Null and empty texts have fingerprint zero.

    Where rows are already partitioned by some of the keys nothing is shuffled.
    """
    df = rows.select(*keys, words(F.coalesce(F.col(text_col), F.lit("")), ASCII_SPACE).alias("w"))
    df = df.select(*keys, F.transform("w", lambda x: F.xxhash64(x)).alias("h")).withColumn("h2", joined("h", ahead("h", 1)))
    terms = joined("h2", ahead("h", 2))
    df = df.select(*keys, F.explode_outer(F.slice(terms, 1, F.greatest(F.size("h") - 2, F.lit(1)))).alias("t"))
    votes = [F.sum(F.shiftrightunsigned("t", j).bitwiseAND(F.lit(LANES))).alias(f"s{j}") for j in range(32)]
    sums = df.groupBy(*keys).agg(F.count("t").alias("n"), *votes)

    def bit(j: int) -> Column:
        both = F.col(f"s{j % 32}")
        votes = both.bitwiseAND(F.lit(0xFFFFFFFF)) if j < 32 else F.shiftrightunsigned(both, 32)
        return F.when(2 * votes > F.col("n"), F.lit((1 << j) - (1 << 64 if j == 63 else 0))).otherwise(F.lit(0).cast("long"))

    return sums.select(*keys, reduce(lambda x, y: x.bitwiseOR(y), map(bit, range(64))).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def near_pairs(prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(a, b, bits), a < b: all pairs of distinct fingerprints in column fp within the radius.

    Copies are collapsed first, and only pairs that hold are emitted.
    """
    if not 0 <= radius < blocks <= 64:
        raise ValueError("0 <= radius < blocks <= 64")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    mask = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    fronts = [sum(mask[k] for k in c) for c in combinations(range(blocks), blocks - radius)]
    some = prints.select("fp").where("fp is not null").distinct()
    keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (m >> 63 << 64))).alias("front")) for t, m in enumerate(fronts)))
    keyed = some.select("fp", F.explode(keys).alias("k")).select("fp", "k.*")
    a, b = keyed.withColumnRenamed("fp", "a"), keyed.withColumnRenamed("fp", "b")
    bits = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return a.join(b, ["t", "front"]).where((F.col("a") < F.col("b")) & (bits <= radius)).select("a", "b", bits.alias("bits")).distinct()


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, place, tail, doc_id, text, next): each document with the next one's text, ascending id.

    Null ids come first, ties stand in the order of their text hashes, the last is
    followed by the first. Ids are cut into ranges at percentiles; a range also gets the
    first document of the next one as its tail, so a window never spans ranges and the
    texts are shuffled once. Rows with tail = true are such second copies.
    """
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    n, low = docs.agg(F.count("*"), F.min(ident)).first()
    parts = min(MOST_BUCKETS, max(1, ceil(n / BUCKET_ROWS)))
    fixed = lambda some, kind: F.expr(f"cast(split('{','.join(map(str, some))}', ',') as array<{kind}>)")  # noqa: E731  one literal, not one node a value
    inner = [k / parts for k in range(1, parts)]
    found = docs.agg(F.percentile_approx(ident, fixed(inner, "double"), F.lit(max(10_000, 20 * parts)))).first()[0] if inner else []
    cuts = sorted({low or 0, *(found or [])})
    # looked up in two steps, among the first cuts of runs of `run` cuts, then in the run
    run = ceil(len(cuts) ** 0.5)
    at, heads = fixed(cuts, "bigint"), fixed(cuts[::run], "bigint")
    below = lambda some: F.size(F.filter(some, lambda c: c <= F.col("i")))
    start = (below(heads) - 1) * run
    own = F.col("start") + below(F.slice(at, F.col("start") + 1, F.lit(run))) - 1
    first = F.get(at, F.col("own")) == F.col("i")
    homes = F.array(
        F.struct(F.col("own").alias("bucket"), F.lit(0).alias("tail")),
        F.when(first & (F.col("own") > 0), F.struct((F.col("own") - 1).alias("bucket"), F.lit(1).alias("tail"))),
        F.when(first & (F.col("own") == 0), F.struct(F.lit(len(cuts) - 1).alias("bucket"), F.lit(1).alias("tail"))),
    )
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), ident.alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("start", start).withColumn("own", own)
    df = df.select("doc_id", "i", "text", F.xxhash64("text").alias("h"), F.explode(F.array_compact(homes)).alias("home"))
    w = Window.partitionBy("bucket").orderBy("tail", "i", "h")
    return df.select("doc_id", "i", "text", "h", "home.*").select("bucket", F.row_number().over(w).alias("place"), (F.col("tail") == 1).alias("tail"), "doc_id", "text", F.coalesce(F.lead("text").over(w), F.lit("")).alias("next"))


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of whole documents, of their edited texts, and how many others are near."""
    return compare_edited(table(spark, sf_dir, "documents"))


def compare_edited(docs: DataFrame, radius: int = 3) -> DataFrame:
    """One row per row of docs: own and edited fingerprint, likenesses, n_near.

    n_near is the number of other distinct fingerprints within the radius. A single
    document is followed by itself.
    """
    df = with_next(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    df = df.select("bucket", "place", "tail", "doc_id", n.cast("long").alias("n_chars"), "text", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half)).alias("edited"))
    keys = ["bucket", "place", "tail", "doc_id", "n_chars", "edited_sha256"]
    both = df.select(*keys[:-1], F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("x")).select(*keys, "x.*")
    prints = fingerprints(both, [*keys, "kind"])
    wide = prints.groupBy(*keys).agg(F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    w = Window.partitionBy("bucket").orderBy("place")
    done = cut(wide.withColumn("next_fp", F.lead("fp").over(w)).where("not tail"))
    pairs = near_pairs(done, radius)
    counts = cut(done.select("fp").distinct().join(pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).groupBy("fp").agg(F.count("*").alias("n_near")), "fp", "left"))
    text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return done.join(counts, "fp").select("doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("edited_fp").alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.coalesce("next_fp", "fp")).alias("near_next"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
