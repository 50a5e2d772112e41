"""A hidden Markov language model over words, trained by Baum-Welch.

The WORDS most frequent training words are symbols of their own; the others are symbols
by their last letters (CLASSES of them), within which a word has its smoothed relative
frequency. Unseen words are one word, as in the base score, with the Good-Turing mass of
words seen once. A state emits a symbol, the symbol a word, and every text ends with an
end token, so the score is the log of a probability over all texts of these words.

Corpus counts are exact and never held whole: documents are cut into blocks of a bounded
number of tokens, a block's distinct words meet the corpus counts in a shuffle and come
back to the block. Expected counts of each Baum-Welch round are summed by symbol across
partitions; only the model (states times symbols) is on the driver.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from mercato.llm import chain
from mercato.session import remove_dir, shared_dir, table

STATES, ROUNDS = 6, 4
WORDS, CLASSES = 8000, 8000
#: A block ends once it has so many tokens.
BLOCK_TOKENS = 2_000_000
END = b"\x20"  # never a word: words hold no white space
_END, _UNSEEN, _FIRST = 0, 1, 2  # symbols


class _Local(dict):
    """Numbers words in the order they come."""

    def __missing__(self, w: bytes) -> int:
        k = self[w] = len(self)
        return k


def _word_hash(w: bytes) -> int:
    h = xxhash.xxh64_intdigest(w)
    return h - (h >> 63 << 64)


def _suffix_class(w: bytes) -> int:
    s = w.decode("utf-8", "replace")
    letters = [c for c in s if c.isalpha()]
    return zlib.crc32("".join(letters[-3:] or s[-1:]).encode()) % CLASSES


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of two kinds: documents (block, doc_id, held_out, local ids) and their block's words (block, word_hash, local, class, n_train)."""
    names = ["block", "doc_id", "held_out", "ids", "word_hash", "local", "class", "n_train"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]

    def out(rows_of, **cols):
        return pa.RecordBatch.from_arrays([pa.array(cols[n], t) if n in cols else pa.nulls(rows_of, t) for n, t in zip(names, types)], names=names)

    def work(batches):
        part, k = TaskContext.get().partitionId(), 0
        local, tokens = _Local(), 0
        count = np.zeros(1, np.int64)

        def words():
            own = list(local)
            for at in range(0, len(own), 50_000):
                w = own[at : at + 50_000]
                yield out(len(w), block=[(part << 24) + k] * len(w), word_hash=[_word_hash(x) for x in w], local=np.arange(at, at + len(w), dtype=np.int32), **{"class": [_suffix_class(x) for x in w]}, n_train=count[at : at + len(w)])

        def counted(new: list[np.ndarray]) -> np.ndarray:
            """count with the training documents' ids added."""
            out = np.bincount(np.concatenate([np.zeros(0, np.int32), *new]), minlength=len(local))
            out[: len(count)] += count[: len(local)]
            return out

        for b in batches:
            ids, held, lists, trained = [], [], [], []
            for i, h, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ws = (x.as_py() or b"").lower().split()
                ws.append(END)
                own = np.fromiter(map(local.__getitem__, ws), np.int32, len(ws))
                if not h:
                    trained.append(own)
                ids.append(i)
                held.append(h)
                lists.append(own.tobytes())
                tokens += len(ws)
                if tokens >= BLOCK_TOKENS:
                    count = counted(trained)
                    yield out(len(ids), block=[(part << 24) + k] * len(ids), doc_id=ids, held_out=held, ids=lists)
                    yield from words()
                    ids, held, lists, trained, local, k, tokens = [], [], [], [], _Local(), k + 1, 0
                    count = np.zeros(1, np.int64)
            if ids:
                count = counted(trained)
                yield out(len(ids), block=[(part << 24) + k] * len(ids), doc_id=ids, held_out=held, ids=lists)
        if local:
            yield from words()

    fold = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))
    some = docs.select(F.col(id_col).cast("long"), fold, F.col(text_col).cast("binary"))
    return some.mapInArrow(work, "block long, doc_id long, held_out boolean, ids binary, word_hash long, local int, class int, n_train long")


def symbols(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(documents as symbols, unigram probabilities of the symbols).

    Documents: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, inner (log10
    probability of the words given their symbols), s (unsigned 16-bit symbols).
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/lm-{uuid.uuid4().hex}"
    blocks(docs).write.parquet(f"{folder}/blocks", compression="zstd")
    held = spark.read.parquet(f"{folder}/blocks")
    local = held.where("word_hash is not null").select("word_hash", "block", "local", "class", "n_train")
    w = Window.partitionBy("word_hash").orderBy("block", "local")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a word is a row a block, never a list of its blocks: frequent words are in all of them
    count, kind = F.sum("n_train").over(every).alias("c"), F.min("class").over(every).alias("class")
    local.select("word_hash", "block", "local", count, kind, (F.row_number().over(w) == 1).alias("once")).write.parquet(f"{folder}/counts", compression="zstd")
    counts = spark.read.parquet(f"{folder}/counts")
    total = counts.where("once").select("word_hash", "c", "class")
    end = _word_hash(END)
    seen = total.where("c > 0")
    n, v, once = seen.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count(F.when(F.col("c") == 1, 1))).first()
    top = seen.where(F.col("word_hash") != end).orderBy(F.desc("c"), "word_hash").limit(WORDS).select("word_hash", "c").collect()
    own = {r["word_hash"]: _FIRST + k for k, r in enumerate(top)}
    frame = spark.createDataFrame([(h, s) for h, s in own.items()] or [(0, -1)], "word_hash long, own int").where("own >= 0")
    named = total.join(F.broadcast(frame), "word_hash", "left")
    rare = named.where((F.col("c") > 0) & F.col("own").isNull() & (F.col("word_hash") != end)).groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()

    size = _FIRST + WORDS + CLASSES
    unigram, inside = np.zeros(size), np.zeros((CLASSES, 2))
    for r in top:
        unigram[own[r["word_hash"]]] = r["c"]
    for r in rare:
        unigram[_FIRST + WORDS + r["class"]] = r["c"]
        inside[r["class"]] = r["c"], r["v"]
    ends = total.where(F.col("word_hash") == end).select("c").first()
    unigram[_END] = ends["c"] if ends else 0
    unseen = (once + 0.1) / (n + 0.2)
    unigram = (unigram + 1e-3) / (unigram + 1e-3).sum() * (1 - unseen)
    unigram[_UNSEEN] = unseen
    below = np.log10(n + 0.1 * (v + 1))

    back = counts.join(F.broadcast(frame), "word_hash", "left").select("block", "local", "c", "class", F.when(F.col("word_hash") == end, _END).otherwise(F.col("own")).alias("own"))
    texts = held.where("ids is not null").select("block", "doc_id", "held_out", "ids")

    def look_up(d: pd.DataFrame, w: pd.DataFrame) -> pd.DataFrame:
        at = np.argsort(w["local"].to_numpy())
        c = w["c"].to_numpy(np.int64)[at]
        kind = w["class"].to_numpy(np.int64)[at]
        sym = w["own"].fillna(-1).to_numpy(np.int64)[at]
        rest = (sym < 0) & (c > 0)
        inner = np.zeros(len(c))
        inner[rest] = np.log10((c[rest] + 0.1) / (inside[kind[rest], 0] + 0.1 * inside[kind[rest], 1]))
        sym = np.where(c == 0, _UNSEEN, np.where(sym < 0, _FIRST + WORDS + kind, sym)).astype("<u2")
        base = np.log10(c + 0.1) - below
        rows = []
        for i, h, ids in zip(d["doc_id"], d["held_out"], d["ids"]):
            x = np.frombuffer(ids, np.int32)
            rows.append((i, h, len(x), int((c[x] > 0).sum()), n, float(base[x].sum()), float(inner[x].sum()), sym[x].tobytes()))
        out = pd.DataFrame(rows, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "inner", "s"])
        return out.astype({"doc_id": "Int64"})

    done = texts.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(look_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, inner double, s binary")
    done.write.parquet(f"{folder}/symbols", compression="zstd")
    for done_with in ("blocks", "counts"):
        remove_dir(spark, f"{folder}/{done_with}")
    return spark.read.parquet(f"{folder}/symbols"), unigram


class Hmm:
    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @staticmethod
    def first(unigram: np.ndarray, states: int = STATES, seed: int = 5) -> Hmm:
        """Equal states, but that each prefers symbols of its own: Baum-Welch can't part equal ones."""
        rng = np.random.default_rng(seed)
        emit = unigram[:, None] * np.exp(0.5 * rng.standard_normal((len(unigram), states)))
        step = np.full((states, states), 0.02 / max(1, states - 1))
        np.fill_diagonal(step, 0.98 if states > 1 else 1)
        return Hmm(np.full(states, 1 / states), step, Hmm._fixed(emit, unigram))

    @staticmethod
    def _fixed(emit: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """Each state's distribution, with the unseen word's probability held."""
        emit = emit.copy()
        emit[_UNSEEN] = 0
        emit = emit / emit.sum(0) * (1 - unigram[_UNSEEN])
        emit[_UNSEEN] = unigram[_UNSEEN]
        return emit

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probabilities of symbol sequences, by the scaled forward recursion."""
        out = np.zeros(len(texts))
        for own in chain.grouped(np.array([len(t) for t in texts])):
            flat, starts = chain.layout(texts, own)
            _, scale = chain.forward(self.emit[flat], starts, self.start, self.step)
            out[own] = chain.per_chain(np.log10(scale), starts)
        return out

    def expected(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts (first states, transitions, symbols by state) and the natural log-likelihood."""
        k = len(self.start)
        start, step, emit, total = np.zeros(k), np.zeros((k, k)), np.zeros_like(self.emit), 0.0
        for own in chain.grouped(np.array([len(t) for t in texts])):
            flat, starts = chain.layout(texts, own)
            e = self.emit[flat]
            alpha, scale = chain.forward(e, starts, self.start, self.step)
            beta = chain.backward(e, starts, scale, self.step)
            m = alpha * beta
            total += float(np.log(scale).sum())
            start += m[: starts[1]].sum(0)
            for j in range(k):
                emit[:, j] += np.bincount(flat, m[:, j], len(emit))
            if len(starts) > 2:
                live = np.diff(starts)[1:]
                prev = np.concatenate([np.arange(x, x + n) for x, n in zip(starts[:-2], live)])
                step += self.step * (alpha[prev].T @ (e[starts[1] :] * beta[starts[1] :] / scale[starts[1] :, None]))
        return start, step, emit, total

    def updated(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray, unigram: np.ndarray, prior: float = 50.0) -> Hmm:
        """The next model; `prior` tokens of the unigram distribution smooth each state."""
        return Hmm((start + 0.1) / (start + 0.1).sum(), (step + 0.1) / (step + 0.1).sum(1, keepdims=True), self._fixed(emit + prior * unigram[:, None], unigram))


def _sequences(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), "<u2") for x in column]


def baum_welch(texts: DataFrame, unigram: np.ndarray, rounds: int = ROUNDS, states: int = STATES) -> tuple[Hmm, list[float]]:
    """A model trained on column s of all rows, and the log-likelihood before each round."""
    sc, model, seen = texts.sparkSession.sparkContext, Hmm.first(unigram, states), []
    for _ in range(rounds):
        now = sc.broadcast(model)  # states times symbols

        def work(batches, now=now):
            sums, any_row = None, False
            for b in batches:
                any_row = any_row or b.num_rows > 0
                new = now.value.expected(_sequences(b.column(0)))
                sums = new if sums is None else tuple(x + y for x, y in zip(sums, new))
            if any_row:
                start, step, emit, total = sums
                used = np.flatnonzero(emit.sum(1))
                keys = [*used, *(-1 - np.arange(len(start))), -100]
                rows = [*emit[used], *step, np.append(total, start[1:])]
                keys.append(-101)
                rows.append(start)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array(c) for c in np.array(rows).T)], names=["k", *(f"v{j}" for j in range(states))])

        cols = [f"v{j}" for j in range(states)]
        got = texts.select("s").mapInArrow(work, "k long, " + ", ".join(f"{c} double" for c in cols)).groupBy("k").agg(*(F.sum(c).alias(c) for c in cols)).toPandas()
        if not len(got):
            break
        by, emit = dict(zip(got["k"], got[cols].to_numpy())), np.zeros_like(model.emit)
        for k, row in by.items():
            if k >= 0:
                emit[k] = row
        seen.append(float(by[-100][0]))
        model = model.updated(by[-101], np.array([by[-1 - j] for j in range(states)]), emit, unigram)
    return model, seen


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of docs.

    Null and empty texts are the end token alone. Null ids are in training. Repeated rows
    count as often as they occur. With nothing to train on every word is unseen. An empty
    table gives no rows. Other columns aren't read.
    """
    texts, unigram = symbols(docs)
    model, _ = baum_welch(texts.where("not held_out"), unigram)
    now = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]

    def work(batches):
        for b in batches:
            score = now.value.scores(_sequences(b.column(7))) + b.column(6).to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(score)], names=[*names, "score"])

    return texts.select(*names, "inner", "s").mapInArrow(work, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5_hmm_score(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
