from collections import defaultdict

import pyarrow as pa

import corpus_pipeline
from mercato.llm import langid, packing, tokens
from mercato.session import table
from tests.llm.test_native import brute_hits

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    """Five-word shingles by themselves, not by any hash or key of the stage."""
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        before = {r.doc_id: r.text for r in docs.collect()}
        if k < 3:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        after = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "language":
            assert all(any(c.isalpha() for c in before[i]) for i in after) and len(after) > 0.95 * len(before)
        elif name == "near_duplicates":
            sets, low = {i: shingle_set(t) for i, t in before.items()}, {i: i for i in before}
            alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
            links = [(a, b) for a in before for b in before if a < b and alike(a, b)]
            for _ in range(20):
                for a, b in links:
                    low[a] = low[b] = min(low[a], low[b])
            assert links and after == set(low.values())
        elif name == "decontamination":
            assert after == {i for i, t in before.items() if not brute_hits(t, items)[4]} and after < set(before)
        docs = out
    seq, enc = defaultdict(list), tokens.Encoder(tokens.default_tokenizer())
    pieces = docs.collect()
    for p in pieces:
        seq[p.sequence_id].append((p.offset, p.length))
    for s in seq.values():
        assert [o for o, _ in sorted(s)] == [sum(n for _, n in sorted(s)[:k]) for k in range(len(s))]
    assert sum(p.length for p in pieces) == sum(len(enc.encode(t)) // 4 + 1 for t in before.values())


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100 and langid.UNKNOWN and packing.WINDOW == 1024


def test_workers_keep_no_pieces(spark):
    """Workers that packed live on in the other stages, without the pieces they looked up."""
    path = tokens.default_tokenizer()
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(400)], "doc_id long, text string").repartition(8)
    assert tokens.pieces(docs).count() == 400

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(tokens.encoder(path).pieces)])], names=["n"])

    assert {r.n for r in spark.range(0, 16, 1, 16).mapInArrow(held, "n long").collect()} == {0}


def test_language_by_runs_of_text(spark):
    """Rows fall to their own texts where one batch is several runs."""
    docs = table(spark, SF, "documents")
    model = langid.fit(docs)
    good = docs.where("lang is not null and length(text) > 400").orderBy("doc_id").first()
    long = (good.text + " ") * (langid.CHUNK // (2 * len(good.text)) + 1)
    rows = [(i, t) for i, t in enumerate([long, "1 2", None, long, long, "", good.text, "...", long, good.text])]
    out = langid.keep_identified(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), model).collect()
    assert {r.doc_id: r.text for r in out} == {i: t for i, t in rows if t and len(t) > 9}
