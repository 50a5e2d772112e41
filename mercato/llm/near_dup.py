"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint is cut into four 16-bit blocks. With three or fewer differing bits one
block is equal, and of the two 24-bit halves of the other 48 bits one differs in at most
one bit (pigeonhole). The Golay code maps the half to a codeword index, or to the few
indices nearby, so that fingerprints one bit apart always share (block, half, index): an
equi-join on these keys loses no link, and every pair is verified by its bit count.

Equal fingerprints are collapsed before anything is joined, so a group of copies of any
size is one row in the join.

Similarity of 0.8 over five-word shingles is far more than 3 of 64 bits. There the same
links are only the first, of each text with the least of its component, verified by exact
Jaccard similarity; then bands of MinHash values tell which texts have a partner at all,
the rarest shingles of these (a prefix that similar sets must share) bring pairs together, parity bitmaps of the sets rule
out pairs that differ in too many shingles (no pair is lost by that: bits that differ are
never more than shingles that do), and the exact Jaccard similarity of their sets of
shingles decides. Wide fingerprints of several tables (wide_links) only estimate it.

Null and empty texts have the fingerprint zero. Repeated rows share a fingerprint; null
ids are kept and never become a component's id unless the whole component has none. An
empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from mercato.llm import golay
from mercato.llm.memory import given_back
from mercato.operators.components import connected_components
from mercato.session import cut, table, tidy

SEED = 42
_CHUNK = 1 << 16
#: Fingerprints of a document for the estimate of its shingles' similarity.
TABLES = 8
#: Up to so many sketches with a link (16 bytes each) their components are broadcast.
BROADCAST_NODES = 500_000
#: MinHash bands of a document and values in a band. A pair of similarity s shares no band with probability (1 - s^ROWS)^BANDS: 5e-8 at 0.8.
BANDS, ROWS = 32, 4
#: Longs of the parity bitmap of a set of shingles.
WORDS = 8
_ODD = [int(x) | 1 for x in np.random.default_rng(7).integers(1 << 62, 1 << 63, 64)]
_MIX, _ADD = np.random.default_rng(11).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64, endpoint=False) | np.uint64(1)


def fingerprint(text: bytes | None, width: int = 3, tables: int = 1) -> list[int]:
    """SimHash of the word shingles (repeats count): per table 64 bits, set where over half the hashes have a 1."""
    words = (text or b"").lower().split()
    if not words:
        return [0] * tables
    n = max(1, len(words) - width + 1)
    votes = np.zeros((tables, 64), np.int64)
    for at in range(0, n, _CHUNK):
        some = words[at : min(at + _CHUNK, n) + width - 1]
        parts = zip(*(some[k:] for k in range(width))) if len(words) >= width else [words]
        h = np.array([xxhash.xxh64_intdigest(b" ".join(p), SEED) for p in parts], np.uint64)
        for t in range(tables):
            if t:  # further tables mix the same hash anew
                h2 = h * np.uint64(_ODD[t])
                h2 ^= h2 >> np.uint64(29)
                h2 *= np.uint64(_ODD[-t])
                h2 ^= h2 >> np.uint64(32)
            bits = np.unpackbits((h2 if t else h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes[t] += np.add.reduceat(bits, np.arange(0, len(bits), 255), 0, np.uint8).sum(0, dtype=np.int64)
    return [int(np.packbits(2 * v > n, bitorder="little").view(np.uint64)[0]) for v in votes]


def fingerprints(docs: DataFrame, width: int = 3, tables: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, f0 .. f<tables-1>): signed 64-bit fingerprints of whole texts."""

    def work(batches):
        for b in batches:
            got = [fingerprint(x.as_py(), width, tables) for x in b.column(2)]
            cols = [pa.array(np.array([g[t] for g in got], np.uint64).view(np.int64)) for t in range(tables)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["doc_id", "text_hash", *(f"f{t}" for t in range(tables))])

    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("b"))
    return some.mapInArrow(work, "doc_id long, text_hash long, " + ", ".join(f"f{t} long" for t in range(tables)))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(_ODD[0])
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_ODD[1])
    return h ^ (h >> np.uint64(29))


def shingles(text: bytes | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer than `width` words are one shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(width, len(words))):
        out = _mixed(out + h[k : k + n])
    return np.unique(out)


def bands(some: np.ndarray) -> np.ndarray:
    """One key a band: a hash of its MinHash values and its number. Nothing for no shingles."""
    if not len(some):
        return np.empty(0, np.uint64)
    least = np.min([(some[at : at + 256, None] * _MIX + _ADD).min(0) for at in range(0, len(some), 256)], axis=0).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = _mixed(key + least[:, r])
    return key


def parity(some: np.ndarray) -> np.ndarray:
    """64 * WORDS bits, each the parity of the number of hashes that fall on it, as longs."""
    odd = np.bincount((some % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def simhash(some: np.ndarray) -> int:
    """64 bits, set where over half of the hashes have a 1; zero for no hashes."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(some), _CHUNK):
        bits = np.unpackbits(some[at : at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += np.add.reduceat(bits, np.arange(0, len(bits), 255), 0, np.uint8).sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(some), bitorder="little").view(np.uint64)[0])


def shingle_sets(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, id, f0, bands, shingles, p0 .. p<WORDS-1>): id stands for the set of shingles, f0 is its SimHash, p are its parity bitmap."""

    def lists(arrays):
        ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).view(np.int64)))

    def work(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                sets = [shingles(x.as_py(), width) for x in b.column(2)]
                ids = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
                bits = np.array([parity(s) for s in sets]).reshape(-1, WORDS)
                words = {f"p{k}": pa.array(np.ascontiguousarray(bits[:, k])) for k in range(WORDS)}
                yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "text_hash": b.column(1), "id": pa.array(ids), "f0": pa.array(np.array([simhash(s) for s in sets], np.uint64).view(np.int64)), "bands": lists([bands(s) for s in sets]), "shingles": lists(sets), **words})

    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("binary").alias("b"))
    return some.mapInArrow(given_back(work), "doc_id long, text_hash long, id long, f0 long, bands array<long>, shingles array<long>" + "".join(f", p{k} long" for k in range(WORDS)))


def _segments(f: np.ndarray):
    """(number, exact block, 23-bit word) of the eight ways to cut a fingerprint."""
    f = f.view(np.uint64)
    for b in range(4):
        at = np.uint64(16 * b)
        exact = (f >> at) & np.uint64(0xFFFF)
        rest = (f & ((np.uint64(1) << at) - np.uint64(1))) | ((f >> at >> np.uint64(16)) << at)
        for s in range(2):
            word = (rest >> np.uint64(24 * s)) & np.uint64(0x7FFFFF)
            yield 2 * b + s, exact.astype(np.int64), word.astype(np.int64)


def _keys(near: bool, tables: int):
    """Rows (key, id, f, home): home where the key is the codeword nearest to the segment itself."""

    def work(batches):
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for t in range(tables):
                f = np.ascontiguousarray(b.column(1 + t).to_numpy(zero_copy_only=False)).astype(np.int64)
                for k, exact, word in _segments(f):
                    own = golay.home(word)
                    at, index = golay.nearby(word) if near else (np.arange(len(word)), own)
                    key = ((t * 8 + k) << 28) | (exact[at] << 12) | index
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids[at]), pa.array(f[at]), pa.array(index == own[at])], names=["key", "id", "f", "home"])

    return work


_KEYED = "key long, id long, f long, home boolean"


def links(sketches: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b), a < b: ids of all sketches with `radius` (at most 3) or fewer differing bits.

    sketches has id and f0, one row an id.
    """
    if radius > 3:
        raise ValueError("the pigeonhole over four blocks holds for at most 3 bits")
    some = sketches.select("id", "f0")
    one = some.mapInArrow(_keys(False, 1), _KEYED).select("key", F.col("id").alias("a"), F.col("f").alias("fa"))
    many = some.mapInArrow(_keys(True, 1), _KEYED).select("key", F.col("id").alias("b"), F.col("f").alias("fb"))
    return one.join(many, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= radius)).select("a", "b").distinct()


def wide_links(sketches: DataFrame, tables: int, max_bits: int) -> DataFrame:
    """(a, b), a < b: links with the components of all pairs that share a key and differ in at most max_bits bits.

    sketches has id and f0 .. f<tables-1>, one row an id. Two sketches share a key where one
    block of one table is equal and a half beside it decodes to the same index for one of
    them and nearby for the other; the whole sketches then decide.
    """
    bits = F.aggregate(F.zip_with("all_a", "all_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    whole = sketches.select("id", F.array(*(f"f{t}" for t in range(tables))).alias("all"))

    def holding(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(whole.select(F.col("id").alias(end), F.col("all").alias(f"all_{end}")), end)
        return cut(pairs.where(bits <= max_bits).select("a", "b"))

    keyed = sketches.select("id", *(f"f{t}" for t in range(tables))).mapInArrow(_keys(True, tables), _KEYED).select("key", "id", "home")
    return _linked(keyed, holding)


def code_links(codes: DataFrame) -> DataFrame:
    """(a, b), a < b: all of these distinct fingerprints, column f0, with 3 or fewer differing bits. As links, but a fingerprint is its own id and sent once a key."""
    some = codes.select(F.col("f0").alias("id"), "f0")
    one = some.mapInArrow(_keys(False, 1), _KEYED).select("key", F.col("f").alias("a"))
    many = some.mapInArrow(_keys(True, 1), _KEYED).select("key", F.col("f").alias("b"))
    return one.join(many, "key").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 3)).select("a", "b").distinct()


def simhash_pairs(sketches: DataFrame) -> DataFrame:
    """(a, b), a < b: each sketch with the least of its component under links: a row a sketch, however large the component.

    sketches has id and f0, one row an id; equal SimHashes are one before any are compared.
    """
    parts = connected_components(code_links(cut(sketches.select("f0").distinct())), "a", "b")
    named = sketches.join(parts, F.col("f0") == F.col("node"), "left").select("id", F.coalesce("component", "f0").alias("part"))
    least = named.groupBy("part").agg(F.min("id").alias("a"))
    return named.join(least, "part").where("id <> a").select("a", F.col("id").alias("b"))


def prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(key, id, size, place): the shingles of the prefix of each set that another set has too, with the set's size and the place in it.

    Places are in the order of how many sets have the shingle, rare ones first. Of two sets
    of this Jaccard similarity or more the first shingle in common is in both prefixes.
    """
    every = sets.select("id", F.size("shingles").alias("size"), F.explode("shingles").alias("key"))
    shared = every.join(every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
    w = Window.partitionBy("id")
    place = F.col("size") - F.count("*").over(w) + F.row_number().over(w.orderBy("n", "key")) - 1
    held = shared.withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * similarity - 1e-9))
    return held.select("key", "id", "size", "place")


def jaccard_links(sets: DataFrame, similarity: float, near: DataFrame) -> DataFrame:
    """(a, b), a < b: links with the components of all pairs whose sets have at least this Jaccard similarity.

    sets has id, shingles and the words of their bitmap, one row an id. The pairs (a, b) of
    near are compared first. A key's sets are then compared with its lead, the one with the
    fewest rare shingles before the key, then with a second lead outside the
    first one's component. Each is a row a set and key, and a group of near copies collapses
    in them. Of what is left only sets of different components that share a key are
    compared, and of those only pairs that their bitmaps let through: no component is lost.
    """
    size = F.size("shingles").alias("size")
    words = [f"p{k}" for k in range(WORDS)]
    small = cut(sets.select("id", size, *words))
    need = lambda n, m: (n + m) * (similarity / (1 + similarity)) - 1e-9  # noqa: E731  the least number in common

    def bits(side: str) -> DataFrame:
        return small.select(F.col("id").alias(side), F.col("size").alias(f"{side}_size"), *(F.col(w).alias(f"{side}_{w}") for w in words))

    def alike(a: str, b: str) -> Column:
        """False where the bitmaps differ in more bits than shingles of such a pair can."""
        n, m = F.col(f"{a}_size"), F.col(f"{b}_size")
        differ = sum((F.bit_count(F.col(f"{a}_{w}").bitwiseXOR(F.col(f"{b}_{w}"))) for w in words), F.lit(0))
        return (n + m - differ) / 2 >= need(n, m)

    def reaches(n: Column, at: Column, m: Column, to: Column) -> Column:
        """False where the key is so late in one of the sets that too few can follow."""
        return F.least(n - at, m - to) >= need(n, m)

    def holding(pairs: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("id").alias(end), F.col("shingles").alias(f"set_{end}")), end)
        n, m, both = F.size("set_a"), F.size("set_b"), F.size(F.array_intersect("set_a", "set_b"))
        return cut(pairs.where(both / (n + m - both) >= similarity).select("a", "b"))

    def led(rows: DataFrame) -> DataFrame:
        """Links of sets with the lead of a key, from rows (id, size, place, lead)."""
        near = rows.where(F.col("id") != F.col("lead.id")).where(reaches(F.col("size"), F.col("place"), F.col("lead.size"), F.col("lead.place")))
        ends = F.least("id", "lead.id").alias("a"), F.greatest("id", "lead.id").alias("b")
        return holding(near.select(*ends).distinct().join(bits("a"), "a").join(bits("b"), "b").where(alike("a", "b")).select("a", "b"))

    w = Window.partitionBy("key")
    mine = F.struct("place", F.xxhash64("id"), "id", "size")
    met = prefixes(sets, similarity).select("key", "id", "size", "place", F.count("*").over(w).alias("n"), F.min(mine).over(w).alias("lead"))
    met = cut(met.where("n > 1").select("key", "id", "size", "place", F.struct("lead.place", "lead.id", "lead.size").alias("lead")))
    tidy(sets.sparkSession)
    links = cut(holding(near.join(bits("a"), "a").join(bits("b"), "b").where(alike("a", "b")).select("a", "b")).unionByName(led(met)).distinct())
    tidy(sets.sparkSession)

    def apart(links: DataFrame) -> DataFrame:
        """Rows of keys with sets of several components, with their component as part."""
        parts = cut(connected_components(links, "a", "b"))
        own = F.broadcast(parts) if parts.count() <= BROADCAST_NODES else parts
        named = met.join(own, F.col("id") == F.col("node"), "left").withColumn("part", F.coalesce("component", "id")).drop("node", "component")
        return named.withColumns({"low": F.min("part").over(w), "high": F.max("part").over(w)}).where("low <> high")

    rows = apart(links)
    first = F.max(F.when(F.col("id") == F.col("lead.id"), F.col("part"))).over(w)
    other = F.min(F.when(F.col("part") != F.col("first"), F.struct("place", F.xxhash64("id"), "id", "size", "part"))).over(w)
    rows = rows.withColumn("first", first).withColumn("lead", other).where(F.col("part") != F.col("lead.part"))
    links = cut(links.unionByName(led(rows)).distinct())
    left = cut(apart(links).select("key", "id", "place", "part"))
    tidy(sets.sparkSession)
    left = left.join(small, "id")
    side = lambda s: left.select("key", F.col("id").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in ("place", "part", "size", *words)))
    on = (F.col("u_part") < F.col("v_part")) & reaches(F.col("u_size"), F.col("u_place"), F.col("v_size"), F.col("v_place")) & alike("u", "v")
    rest = side("u").join(side("v"), "key").where(on).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    return links.unionByName(holding(rest)).distinct()


def _linked(keyed: DataFrame, holding: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b), a < b: of the pairs that share a key, one of them at home there, links with the components of those that `holding` keeps.

    A key's sketches are first compared with one of those at home there, chosen by hash. Sketches that
    link to it are in one component, so of the key's other pairs only those with a sketch
    that didn't link, and of two different components of the links so far, are compared: no
    component is lost.
    """
    w = Window.partitionBy("key")
    met = keyed.select("key", "id", "home", F.count("*").over(w).alias("n"), F.min(F.when(F.col("home"), F.struct(F.xxhash64("key", "id"), "id"))).over(w).alias("least"))
    met = cut(met.where("n > 1 and least is not null").select("key", "id", "home", F.col("least.id").alias("lead")))
    led = holding(met.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct())
    parts = cut(connected_components(led, "a", "b"))
    own = F.broadcast(parts) if parts.count() <= BROADCAST_NODES else parts
    named = met.where("id <> lead").join(own, F.col("id") == F.col("node"), "left").withColumn("part", F.coalesce("component", "id")).drop("node", "component")
    # the lead is in its key's comparison already: a key whose sketches are all in one part has nothing to add
    named = named.withColumns({"low": F.min("part").over(w), "high": F.max("part").over(w)}).where("low <> high")
    alone = named.join(led, (F.col("lead") == F.col("a")) & (F.col("id") == F.col("b")), "left_anti")
    alone = alone.select("key", F.col("id").alias("u"), F.col("home").alias("u_home"), F.col("part").alias("u_part"))
    other = named.select("key", F.col("id").alias("v"), "home", F.col("part").alias("v_part"))
    ends = F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")
    rest = holding(alone.join(other, "key").where("u_part <> v_part and (home or u_home)").select(*ends).distinct())
    return led.unionByName(rest).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def groups(docs: DataFrame, width: int = 3, radius: int = 3, tables: int = 1, max_bits: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(prints, classes): by `radius` over one table, or by max_bits over several.

    prints: doc_id, text_hash, f0.., id: one row per row of docs; id stands for the sketch.
    classes: id, component, first: one row per sketch; first is the smallest
    (doc_id is null, doc_id, text_hash) of the whole component.
    """
    names = [f"f{t}" for t in range(tables)]
    ident = F.col("f0") if tables == 1 else F.xxhash64(*names)
    prints = cut(fingerprints(docs, width, tables, id_col, text_col).withColumn("id", ident))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    sketches = cut(prints.groupBy("id", *names).agg(F.min(order).alias("first")))
    found = links(sketches, radius) if max_bits is None else wide_links(sketches, tables, max_bits)
    parts = connected_components(found, "a", "b").withColumnRenamed("node", "id")
    classes = sketches.select("id", "first").join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    first = classes.groupBy("component").agg(F.min("first").alias("first"))
    return prints, cut(classes.select("id", "component").join(first, "component"))


def with_component_ids(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """prints with component and component_id, the smallest doc_id of the component."""
    return prints.join(classes.select("id", "component", F.col("first.doc_id").alias("component_id")), "id")


def similar_bits(similarity: float, tables: int) -> int:
    """Differing bits of 64 * tables at a given Jaccard similarity of shingle sets of one size."""
    return math.floor(64 * tables * math.acos(2 * similarity / (1 + similarity)) / math.pi)


def similar_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component, first) as groups gives them, for sets of shingles of at least this Jaccard similarity.

    SimHashes linked through their Golay keys, verified, link the nearest copies; bands and
    the exact join find the other pairs, most of which differ in more bits than such keys bear.
    """
    prints = shingle_sets(docs, width).select("doc_id", "text_hash", "id", "f0", "bands")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    sketches = cut(prints.groupBy("id").agg(F.min(order).alias("first"), F.any_value("f0").alias("f0"), F.any_value("bands").alias("bands")))
    near = cut(simhash_pairs(sketches.where(F.size("bands") > 0).select("id", "f0")))
    tidy(docs.sparkSession)
    shared = sketches.select("id", F.explode("bands").alias("key")).withColumn("n", F.count("*").over(Window.partitionBy("key")))
    some = shared.where("n > 1").select("id").union(near.select("a")).union(near.select("b")).distinct()
    met = sketches.join(some, "id")
    # the sets, larger than the texts, are made again for those with a partner, of copies for the first
    want = cut(met.select(F.col("first.doc_id").alias("want_id"), F.col("first.text_hash").alias("want_hash")))
    want = F.broadcast(want) if want.count() <= BROADCAST_NODES else want
    docs = docs.select("doc_id", "text")
    on = docs["doc_id"].cast("long").eqNullSafe(want["want_id"]) & (F.xxhash64(docs["text"]) == want["want_hash"])
    sets = cut(shingle_sets(docs.join(want, on, "left_semi"), width).drop("doc_id", "text_hash", "f0", "bands").dropDuplicates(["id"]))
    tidy(docs.sparkSession)
    found = jaccard_links(sets, similarity, near)
    parts = connected_components(found, "a", "b").withColumnRenamed("node", "id")
    classes = sketches.select("id", "first").join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    first = classes.groupBy("component").agg(F.min("first").alias("first"))
    return cut(classes.select("id", "component").join(first, "component"))


def deduplicate(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one document of each near-duplicate group: the smallest (doc_id, text hash), nulls last.

    Columns stay as they are, whatever their names; of repeated rows (one id, one text) one
    stays; texts without words, null ones too, are one group. An empty table gives an empty one.
    """
    tag = uuid.uuid4().hex
    ident, text = f"id_{tag}", f"hash_{tag}"
    classes = similar_groups(docs, width, similarity)
    kept = classes.select(F.col("first.doc_id").alias(ident), F.col("first.text_hash").alias(text)).distinct()
    marked = docs.withColumns({ident: F.col("doc_id").cast("long"), text: F.xxhash64("text")})
    on = marked[ident].eqNullSafe(kept[ident]) & (marked[text] == kept[text])
    return marked.join(kept, on, "left_semi").dropDuplicates([ident, text]).select(*docs.columns)


def op3_near_dup(spark, sf_dir: str) -> DataFrame:
    """Fingerprints over 3-word shingles, linked at 3 or fewer bits: doc_id, fingerprint, component_id."""
    done = with_component_ids(*groups(table(spark, sf_dir, "documents")))
    return done.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")
