"""Benchmark decontamination by winnowing, in DataFrame operations alone.

Of every window of ten consecutive words the least 5-gram hash is the window's fingerprint.
Equal windows have equal fingerprints, so an equi-join of the documents' and the
benchmark's fingerprints meets every shared span of ten words; runs of windows with one
fingerprint are joined once. A hit is extended: the words around it are compared with the
benchmark's window, word by word, by their 64-bit hashes.

Items of fewer than ten words are windows of their own length and have one fingerprint,
their n-gram's; documents are looked up by n-grams of the lengths that occur.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.text_sql import NOT_WORD, ahead, joined, lower_ascii, lower_of, words
from mercato.session import cut, table

WINDOW, GRAM = 10, 5
#: Up to so many benchmark windows, whose words and item ids take at most so many bytes, the
#: join is a broadcast join and a bitmap of their fingerprints thins the documents' before
#: they are unnested; beyond, both sides are shuffled.
BROADCAST_FINGERPRINTS, BROADCAST_BYTES = 50_000, 32_000_000


def _grams(df: DataFrame) -> DataFrame:
    """Adds g1 .. g9, hashes of the n-grams at each place, from the word hashes h."""
    df = df.withColumn("g2", joined("h", ahead("h", 1)))
    df = df.withColumn("g4", joined("g2", ahead("g2", 2)))
    return df.withColumn("g5", joined("g4", ahead("h", 4)))


def _gram(n: int) -> Column:
    """Hashes of n-grams, n < 10, of arrays made by _grams."""
    if n == 1:
        return F.col("h")
    if n in (2, 4, 5):
        return F.col(f"g{n}")
    if n == 3:
        return joined("g2", ahead("h", 2))
    return joined("g5", ahead(_gram(n - 5), 5))


def _minima(df: DataFrame) -> DataFrame:
    """Adds m: the least 5-gram hash of the window at each place."""
    df = df.withColumn("m2", lower_of("g5", ahead("g5", 1)))
    return df.withColumn("m", lower_of(lower_of("m2", ahead("m2", 2)), ahead("m2", 4))).drop("m2")


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(fp, window, n, items): each distinct window once, with the sorted set of its items' ids."""
    w = words(lower_ascii(F.col(text_col)), NOT_WORD)
    some = items.select(F.col(id_col).cast("string").alias("item"), F.transform(w, lambda x: F.xxhash64(x)).alias("h")).where("size(h) > 0")
    some = _minima(_grams(some))
    long = some.where(f"size(h) >= {WINDOW}").select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("h") - WINDOW + 1), lambda s: F.struct(F.get("m", s - 1).alias("fp"), F.slice("h", s, WINDOW).alias("window")))).alias("w"))
    out = long.select("item", "w.fp", "w.window")
    for n in range(1, WINDOW):
        out = out.unionByName(some.where(F.size("h") == n).select("item", F.get(_gram(n), F.lit(0)).alias("fp"), F.col("h").alias("window")))
    return out.groupBy("fp", "window").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn("n", F.size("window"))


def _maybe(fp: Column, known: list[int]) -> Column:
    """False for most fingerprints that aren't known: a bitmap of 16 to 32 bits a known one, looked up by low bits."""
    bits = 1 << max(10, (16 * len(known)).bit_length())
    held = [0] * (bits // 64)
    for f in known:
        held[(f & (bits - 1)) >> 6] |= 1 << (f & 63)
    text = ",".join(str(x - (x >> 63 << 64)) for x in held)
    at = fp.bitwiseAND(F.lit(bits - 1))
    return F.getbit(F.get(F.expr(f"cast(split('{text}', ',') as array<bigint>)"), F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1


def _short_places(n: int, known: list[int] | None) -> Column:
    """(fp, s, around) of the n-grams in short<n>, n < 10; of the known ones if those are few."""
    count = F.greatest(F.col("n_words") - n + 1, F.lit(0)).cast("int")
    at = F.transform(F.slice(f"short{n}", F.lit(1), count), lambda x, i: F.struct(x.alias("fp"), (i + 1).alias("s")))
    if known is not None:
        at = F.filter(at, lambda r: _maybe(r["fp"], known))
    return F.transform(at, lambda r: F.struct(r["fp"].alias("fp"), r["s"].alias("s"), F.slice("h", r["s"], F.lit(n)).alias("around")))


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of docs.

    Null and empty texts have no words. Documents with one id and one text are looked up
    once and returned as often as they occur. Items without a word are never met; items
    without an id are met but not named. Either table may be empty. Other columns of docs
    aren't read.
    """
    bench = cut(benchmark_windows(items))
    held = 32 + 8 * F.col("n") + F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x) + 16)
    size = bench.agg(F.count("*").alias("n"), F.coalesce(F.sum(held), F.lit(0)).alias("bytes"), F.collect_set(F.when(F.col("n") < WINDOW, F.col("n"))).alias("short")).first()
    small = size["n"] <= BROADCAST_FINGERPRINTS and size["bytes"] <= BROADCAST_BYTES
    known = {n: [r["fp"] for r in bench.where((F.col("n") == n) if n < WINDOW else (F.col("n") >= n)).select("fp").distinct().collect()] for n in [WINDOW, *size["short"]]} if small else {}

    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), words(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), NOT_WORD).alias("w"))
    df = df.select("doc_id", "text_hash", F.transform("w", lambda x: F.xxhash64(x)).alias("h")).withColumn("n_words", F.size("h").cast("long"))
    df = _minima(_grams(df)).withColumn("m", F.slice("m", 1, F.greatest(F.col("n_words") - WINDOW + 1, F.lit(0)).cast("int")))
    # a column that a lambda reads must be read twice, else the optimizer puts its expression into the lambda
    heads = F.transform("m", lambda x, i: F.when((i == 0) | (x != F.get("m", i - 1)), F.struct(x.alias("fp"), (i + 1).alias("s"))))
    df = df.withColumn("heads", F.array_compact(heads))
    end = F.size("m") + 1
    runs = F.transform("heads", lambda r, i: F.struct(r["fp"].alias("fp"), r["s"].alias("s"), F.coalesce(F.get("heads", i + 1)["s"], end).alias("e")))
    if small:
        runs = F.filter(runs, lambda r: _maybe(r["fp"], known[WINDOW]))
    found = F.transform(runs, lambda r: F.struct(r["fp"].alias("fp"), r["s"].alias("s"), F.slice("h", r["s"], r["e"] - r["s"] + WINDOW - 1).alias("around")))
    # each document's marker row (s = 0) meets no window; a hash of its own spreads the markers where the join is by fp
    parts = [F.array(F.struct(F.xxhash64("doc_id", "text_hash").alias("fp"), F.lit(0).alias("s"), F.array().cast("array<bigint>").alias("around"))), found]
    for n in sorted(size["short"]):
        df = df.withColumn(f"short{n}", _gram(n))
        parts.append(_short_places(n, known.get(n)))
    rows = df.select("doc_id", "text_hash", "n_words", F.explode(F.concat(*parts)).alias("c")).select("doc_id", "text_hash", "n_words", "c.*")

    side = F.broadcast(bench) if small else bench
    own = rows.withColumnRenamed("fp", "doc_fp")
    met = own.join(side, (F.col("doc_fp") == F.col("fp")) & (F.col("s") > 0), "left")
    offsets = F.when(F.size("around") >= F.col("n"), F.sequence(F.lit(0), F.size("around") - F.col("n"))).otherwise(F.array().cast("array<int>"))
    at = F.transform(F.filter(offsets, lambda o: F.slice("around", o + 1, F.col("n")) == F.col("window")), lambda o: o + F.col("s"))
    met = met.withColumn("at", F.when(F.col("n").isNotNull(), at)).where("s = 0 or size(at) > 0")
    span = F.when(F.col("s") > 0, F.struct("n", "at"))
    per = met.groupBy("doc_id", "text_hash", "n_words").agg(F.sum(F.when(F.col("s") == 0, 1).otherwise(0)).alias("copies"), F.collect_set(span).alias("spans"), F.collect_set(F.when(F.col("s") > 0, F.col("items"))).alias("named"))
    places = F.flatten(F.transform("spans", lambda p: F.flatten(F.transform(p["at"], lambda s: F.sequence(s, s + p["n"] - 1)))))
    names = F.array_sort(F.array_distinct(F.flatten("named")))
    per = per.withColumns({"n_hit": F.size(F.array_distinct(places)).cast("long"), "ids": names})
    per = per.select("doc_id", "text_hash", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return per.drop("copy")


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs, columns as they are, whatever their names, without documents that share a window with an item.

    Null and empty texts share none; repeated rows share their fate; with no items, or an
    empty table, docs come back.
    """
    tag = uuid.uuid4().hex
    bad_id, bad_hash, own_id, own_hash = (f"{x}_{tag}" for x in ("bad_id", "bad_hash", "own_id", "own_hash"))
    bad = hits(docs, items).where("contaminated").select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()
    marked = docs.withColumns({own_id: F.col("doc_id").cast("long"), own_hash: F.xxhash64("text")})
    return marked.join(bad, marked[own_id].eqNullSafe(bad[bad_id]) & (marked[own_hash] == bad[bad_hash]), "left_anti").select(*docs.columns)


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


#: The same by brute force: every window of every item against every window of every document.
OP10_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
items AS (
  SELECT DISTINCT id, n, w[s:s + n - 1] AS win FROM (
    SELECT id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM w WHERE kind = 'b' AND len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM items),
docs AS (
  SELECT id, n, s, w[s:s + n - 1] AS win FROM (
    SELECT id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM w, lengths WHERE kind = 'd' AND len(w) >= n)),
hit AS (SELECT docs.id, docs.s, docs.n, items.id AS item FROM docs JOIN items ON docs.win = items.win AND docs.n = items.n),
places AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY id),
named AS (SELECT id, count(DISTINCT item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM hit) GROUP BY id)
SELECT w.id AS doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN places ON places.id = w.id LEFT JOIN named ON named.id = w.id WHERE kind = 'd'
"""
