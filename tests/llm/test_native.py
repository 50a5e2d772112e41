import hashlib
import random
import re

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from mercato.llm import decontaminate, simhash

DOCS = "doc_id long, text string, fp string, item string, n int"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute_hits(text, items):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    hit, named = set(), set()
    for i, t in items:
        v = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        n = min(10, len(v))
        wins = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
        for s in range(len(w) - n + 1):
            if n and tuple(w[s : s + n]) in wins:
                hit |= set(range(s, s + n))
                named.add(str(i))
    ids = ",".join(sorted(named))
    return len(w), len(hit), len(named), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def test_hits_against_brute_force(spark):
    r = random.Random(6)
    vocab = ["the", "É", "é", "Ab1", "zz", "ß", "q"]
    some = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, some(r.choice([1, 3, 7, 9, 10, 11, 25]))) for i in range(25)] + [(90, None), (91, "..."), (92, "the the the the the the the the the the the the"), (93, some(40)), (94, "É é")]
    docs = [(i, some(r.randrange(0, 60))) for i in range(40)]
    docs += [(100 + i, some(12) + " , " + items[r.randrange(25)][1].upper() + "; " + some(9)) for i in range(25)]
    docs += [(300, None), (301, ""), (302, "the " * 300), (303, items[-2][1]), (303, items[-2][1]), (None, items[-2][1])]
    frame = spark.createDataFrame([(*d, "f", "i", 1) for d in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(i), *brute_hits(t, items)) for i, t in docs)
    for limit, size in ((50_000, 32_000_000), (0, 32_000_000), (50_000, 100)):
        decontaminate.BROADCAST_FINGERPRINTS, decontaminate.BROADCAST_BYTES = limit, size
        got = decontaminate.hits(frame, bench).drop("text_hash").collect()
        assert sorted((str(g[0]), *g[1:]) for g in got) == want
    decontaminate.BROADCAST_FINGERPRINTS, decontaminate.BROADCAST_BYTES = 50_000, 32_000_000
    kept = decontaminate.remove_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(str(x.doc_id) for x in kept.collect()) == sorted(w[0] for w in want if not w[5])
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.hits(frame, none).where("contaminated").count() == 0
    assert decontaminate.hits(spark.createDataFrame([], DOCS), bench).count() == 0


def test_hits_against_sql(spark):
    d = "/root/testdata/sf0.001"
    got = decontaminate.op10_decontamination(spark, d).toPandas()
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    want = c.execute(decontaminate.OP10_SQL).df()
    by = lambda x: x.sort_values("doc_id").reset_index(drop=True)[sorted(x.columns)]
    pd.testing.assert_frame_equal(by(got), by(want), check_dtype=False)
    assert 0 < got.contaminated.sum() < len(got)


def test_edited_texts(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdé") for _ in range(5))
    docs = [(i * 7 - 30, " ".join(word() for _ in range(r.randrange(1, 200)))) for i in range(90)]
    docs += [(5000, None), (5001, ""), (5002, "x"), (5003, docs[0][1]), (None, "first of all")]
    simhash.BUCKET_ROWS = 10
    got = simhash.compare_edited(spark.createDataFrame([(*d, "f", "i", 1) for d in docs], DOCS)).collect()
    simhash.BUCKET_ROWS = 2000
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    rows = {g.doc_id: g for g in got}
    assert len(got) == len(docs)
    for (i, t), (j, u) in zip(order, order[1:] + order[:1]):
        t, u, g = t or "", u or "", rows[i]
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 64
        assert g.near_edited == bits(g.fingerprint, g.edited_fingerprint)
        assert g.near_next == bits(g.fingerprint, rows[j].fingerprint)
    assert rows[5003].fingerprint == rows[docs[0][0]].fingerprint
    long = [g for g in got if g.n_chars > 300]
    assert sum(g.near_edited for g in long) / len(long) > 0.6 > sum(g.near_next for g in long) / len(long)
    assert simhash.compare_edited(spark.createDataFrame([], DOCS)).count() == 0


def test_votes_against_brute_force(spark):
    texts = ["a b c d e a b c", "one", "one two", "", None, "q " * 5000, "tab\tnew\nline x"]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.fp for r in simhash.fingerprints(frame, ["k"]).collect()}
    h = lambda cols, vals: spark.createDataFrame([vals], cols).select(F.xxhash64(*[c.split()[0] for c in cols.split(", ")])).first()[0]
    for k, t in enumerate(texts):
        w = [h("a string", (x,)) for x in (t or "").split()[:60]]
        if k == 5:
            continue
        pair = [h("a long, b long", (x, y)) for x, y in zip(w, [*w[1:], None])]
        tri = [h("a long, b long", (x, y)) for x, y in zip(pair, [*w[2:], None, None])][: max(1, len(w) - 2)]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in tri) > len(tri))
        assert got[k] % (1 << 64) == want, t
    assert got[5] == h("a long, b long", (h("a long, b long", (h("a string", ("q",)),) * 2), h("a string", ("q",))))


def test_near_pairs(spark):
    r = random.Random(9)
    base = [r.getrandbits(64) for _ in range(30)]
    prints = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randrange(6))) for b in base for _ in range(6)})
    signed = [p - (p >> 63 << 64) for p in prints]
    for radius, blocks in ((3, 6), (1, 3), (0, 1), (4, 6)):
        got = {(x.a, x.b) for x in simhash.near_pairs(spark.createDataFrame([(p,) for p in signed * 2], "fp long"), radius, blocks).collect()}
        want = {(x, y) for x in signed for y in signed if x < y and ((x ^ y) & (1 << 64) - 1).bit_count() <= radius}
        assert got == want
