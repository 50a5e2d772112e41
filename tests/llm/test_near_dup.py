import random

import numpy as np
import xxhash

from mercato.llm import golay, near_dup

SCHEMA = "doc_id long, text string, f0 string, id int"


def brute_print(text):
    words = near_words(text)
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near_words(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def test_golay_neighbours_share_an_index():
    r = np.random.default_rng(0)
    x = r.integers(0, 1 << 23, 3000)
    at, index = golay.nearby(x)
    near = {i: set() for i in range(len(x))}
    for i, k in zip(at, index):
        near[i].add(k)
    assert set(map(len, near.values())) == {1, 6}
    for bit in range(-1, 23):
        y = x if bit < 0 else x ^ (1 << bit)
        assert all(h in near[i] for i, h in enumerate(golay.home(y)))


def test_links_against_brute_force(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    prints = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randrange(6))) for b in base for _ in range(8)})
    rows = [(i, p - (p >> 63 << 64)) for i, p in enumerate(prints)]
    got = {tuple(x) for x in near_dup.links(spark.createDataFrame(rows, "id long, f0 long")).collect()}
    want = {(i, j) for i in range(len(prints)) for j in range(i + 1, len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 3}
    assert got == want and want


def test_groups_and_edge_cases(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(4))
    texts = []
    for _ in range(12):
        ws = [word() for _ in range(120)]
        texts += [" ".join(ws), " ".join(ws).upper(), "\t ".join([*ws[:60], "new", *ws[60:]]), " ".join(ws[:119])]
    texts += [None, "", " \n ", "one", "One", "two words", "x " * 70000, "a\x00b c d", "a\xa0b c d"]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(3, texts[3], "clash", 1), (None, "lonely text here", "c", 2)]
    got = near_dup.with_component_ids(*near_dup.groups(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(got) == len(rows)
    prints = {i: brute_print(t) for i, t, *_ in rows if i is not None}
    comp = {i: i for i in prints}
    for _ in range(10):
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 3:
                    comp[i] = comp[j] = min(comp[i], comp[j])
    for g in got:
        if g.doc_id is None:
            assert g.component_id is None
        else:
            assert g.f0 % (1 << 64) == prints[g.doc_id]
            assert g.component_id == comp[g.doc_id]
    assert near_dup.with_component_ids(*near_dup.groups(spark.createDataFrame([], SCHEMA))).count() == 0


def test_deduplicate_keeps_one(spark):
    r = random.Random(2)
    rows = []
    for g in range(10):
        ws = ["w%d" % r.randrange(10**6) for _ in range(300)]
        rows += [(4 * g, " ".join(ws)), (4 * g + 1, " ".join(ws)), (4 * g + 2, " ".join([*ws[:150], "zz", *ws[151:]])), (4 * g + 2, " ".join(ws))]
    rows += [(None, "quite other words"), (None, "quite other words")]
    out = near_dup.deduplicate(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, id string"))
    assert out.columns == ["doc_id", "text", "id"]
    ids = [x.doc_id for x in out.collect()]
    assert sorted(i for i in ids if i is not None) == [4 * g for g in range(10)] and ids.count(None) == 1


def test_wide_links_have_the_components_of_all_pairs(spark):
    """Crowded keys: a chain of near texts, so that a key's least sketch links to some of its sketches alone."""
    r = random.Random(4)
    rows = []
    for _ in range(5):
        ws = ["w%d" % r.randrange(10**6) for _ in range(150)]
        for k in range(40):
            ws[r.randrange(150)] = "n%d" % r.randrange(10**6)
            rows.append(" ".join(ws))
    tables, most = 4, near_dup.similar_bits(0.8, 4)
    prints = [near_dup.fingerprint(t.encode(), 5, tables) for t in rows]
    frame = spark.createDataFrame([(i, *(x - (x >> 63 << 64) for x in p)) for i, p in enumerate(prints)], "id long, f0 long, f1 long, f2 long, f3 long")
    got = {tuple(x) for x in near_dup.wide_links(frame, tables, most).collect()}
    sides = []
    for near in (False, True):
        keys = [set() for _ in prints]
        for b in near_dup._keys(near, tables)([_arrow(prints, tables)]):
            for key, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                keys[i].add(key)
        sides.append(keys)
    d = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(prints[a], prints[b]))
    n = range(len(prints))
    want = {(a, b) for a in n for b in n if a < b and d(a, b) <= most and (sides[0][a] & sides[1][b] or sides[1][a] & sides[0][b])}
    assert got <= want and len(got) < len(want)
    assert _components(got, n) == _components(want, n)
    assert near_dup.wide_links(frame.limit(0), tables, most).count() == 0


def _arrow(prints, tables):
    import pyarrow as pa

    cols = [np.array([p[t] for p in prints], np.uint64).view(np.int64) for t in range(tables)]
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(prints))), *map(pa.array, cols)], names=["id", *(f"f{t}" for t in range(tables))])


def _components(pairs, nodes):
    low = {i: i for i in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            m = min(low[a], low[b])
            moved = moved or low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_deduplicate_against_brute_force_jaccard(spark):
    """Pairs around 0.8, on both sides: texts of 100 to 300 words of which some in a row are others."""
    r = random.Random(9)
    rows = []
    for _ in range(120):
        ws = ["w%d" % r.randrange(10**6) for _ in range(r.randrange(100, 300))]
        rows.append(" ".join(ws))
        for _ in range(2):
            n = r.randrange(len(ws) // 25, len(ws) // 6)
            at = r.randrange(len(ws) - n)
            rows.append(" ".join([*ws[:at], *("n%d" % r.randrange(10**6) for _ in range(n)), *ws[at + n :]]))
    rows += ["a b c", "A  b C", "a b d", ""]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in rows)]
    n = range(len(rows))
    near = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in n for b in n if a < b}
    links = [p for p, s in near.items() if s >= 0.8]
    assert sum(0.8 <= s < 0.85 for s in near.values()) > 20 and sum(0.75 <= s < 0.8 for s in near.values()) > 20
    out = near_dup.deduplicate(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    assert {x.doc_id for x in out.collect()} == set(_components(links, n).values())


def test_bitmaps_never_differ_in_more_bits_than_sets_in_shingles():
    r = np.random.default_rng(3)
    for _ in range(200):
        both, a, b = (r.integers(0, 1 << 63, r.integers(0, n), dtype=np.uint64) for n in (900, 60, 60))
        x, y = (np.unique(np.concatenate([both, one])) for one in (a, b))
        bits = sum(int(v ^ w).bit_count() for v, w in zip(*(near_dup.parity(s).view(np.uint64).tolist() for s in (x, y))))
        assert bits <= len(np.setxor1d(x, y)) and (len(np.setxor1d(x, y)) > 20 or bits >= len(np.setxor1d(x, y)) - 8)
    assert not near_dup.parity(np.empty(0, np.uint64)).any()


def test_deduplicate_a_crowd_of_near_copies_and_clashing_columns(spark):
    """Variants of one text, so that most share each key and many pairs are just under or over 0.8."""
    r = random.Random(21)
    base = ["w%d" % r.randrange(10**6) for _ in range(120)]
    rows = []
    for i in range(260):
        ws = list(base)
        for _ in range(r.randrange(0 if i % 50 == 49 else 1, 6)):
            ws[r.randrange(120)] = "n%d" % r.randrange(10**6)
        rows.append(" ".join(ws))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in rows)]
    n = range(len(rows))
    links = [(a, b) for a in n for b in n if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = set(_components(links, n).values())
    frame = spark.createDataFrame([(i, t, i, "h", "x") for i, t in enumerate(rows)], "doc_id long, text string, __id long, __hash string, key string")
    out = near_dup.deduplicate(frame)
    assert out.columns == frame.columns and {x.doc_id for x in out.collect()} == want and 1 < len(want) < 200
    assert near_dup.deduplicate(frame.limit(0)).count() == 0


def test_stage_links_simhashes_first_and_verifies_them(spark, monkeypatch):
    """the pipeline's stage links SimHashes by their Golay keys, and exact similarity decides on these links too."""
    some = near_dup.shingles(" ".join(f"w{i % 37}x{i % 11}" for i in range(600)).encode())
    ones = [sum(int(h) >> b & 1 for h in some) for b in range(64)]
    assert near_dup.simhash(some) == sum(1 << b for b, n in enumerate(ones) if 2 * n > len(some)) and near_dup.simhash(some[:0]) == 0

    prints = [0, 0b111, 0b111000111, 1 << 40, (1 << 63) | (1 << 50) | 0xFFFF0000, (1 << 50) | 0xFFFF0000, 0]
    rows = [(k + 1, f - (1 << 64) if f >> 63 else f) for k, f in enumerate(prints)]
    least = {k: k for k, _ in rows}
    for _ in rows:
        for (j, f), (k, g) in [(u, v) for u in rows for v in rows]:
            if bin((f ^ g) & (1 << 64) - 1).count("1") <= 3:
                least[j] = least[k] = min(least[j], least[k])
    got = near_dup.simhash_pairs(spark.createDataFrame(rows, "id long, f0 long")).collect()
    assert sorted((x.a, x.b) for x in got) == sorted((v, k) for k, v in least.items() if v != k)

    seen = []
    real = near_dup.simhash_pairs
    monkeypatch.setattr(near_dup, "simhash", lambda some: 5 if len(some) else 0)  # all texts one SimHash: verification alone parts them
    monkeypatch.setattr(near_dup, "simhash_pairs", lambda sketches: seen.append(1) or real(sketches))
    words = [[f"{c}{i}" for i in range(60)] for c in "abc"]
    texts = [" ".join(words[0]), " ".join(words[0][:-1] + ["end"]), " ".join(words[1]), " ".join(words[2]), " ".join(words[2])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(x.doc_id for x in near_dup.deduplicate(docs).collect()) == [0, 2, 3] and seen
