"""Language identification by a linear-chain conditional random field over words.

Word features: affixes, character bigrams and trigrams, the word itself, and membership
in each language's lexicon of frequent words. The transitions between labels are learned
on sequences spliced from spans of several languages, since whole documents alone would
never show a switch. Forward-backward gives each word's label distribution; a document's
language has the largest mean, which is its score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm import chain
from mercato.llm.memory import given_back
from mercato.session import table

HASHED = 1 << 16
#: At most so many labelled documents of a language train the model (whole texts).
SAMPLE_PER_LANGUAGE = 150
LEXICON = 300
SEQUENCES, STEPS = 6000, 24
#: Words whose emissions a worker keeps, and characters of text it takes at once: they bound its memory, not the answers.
KEPT_WORDS, CHUNK = 200_000, 1_000_000
UNKNOWN = "und"
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(1_000_003)


def has_letter(word: str) -> bool:
    """Whether some character is of the Unicode category L: numerals such as ½ or Ⅷ are not letters."""
    return any(map(str.isalpha, word))


def _fold(h: np.ndarray, kind: int) -> np.ndarray:
    """64-bit values to feature numbers; each kind of feature has its own place."""
    h = (h ^ (h >> np.uint64(32))) + np.uint64(kind << 40)
    return ((h * _MIX) >> np.uint64(64 - HASHED.bit_length() + 1)).astype(np.int64)


def features(words: list[str], lexicon: dict[str, list[int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, feature numbers) by kind of feature; owners ascend. Words are lower-case, without the signs around them, and not empty."""
    if not words:
        return
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    n = np.array([len(b) for b in raw])
    all_of = np.arange(len(words))
    flat = np.frombuffer(b"^" + b"$^".join(raw) + b"$", np.uint8).astype(np.uint64)
    end = np.cumsum(n + 2) - 1  # of each word's $
    first = end - n
    eight = np.uint64(8)
    two = (flat[:-1] << eight) | flat[1:]
    three = (two[:-1] << eight) | flat[2:]
    keep = np.ones(len(flat), bool)
    keep[end] = False
    yield np.repeat(all_of, n + 1), _fold(two[keep[:-1]], 3)
    keep[end - 1] = False
    yield np.repeat(all_of, n), _fold(three[keep[:-2]], 4)
    power = np.cumprod(np.full(n.max(), _BASE, np.uint64))
    inner = np.ones(len(flat), bool)
    inner[end] = inner[first - 1] = False
    owner = np.repeat(all_of, n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    yield all_of, _fold(np.add.reduceat(flat[inner] * power[place], np.cumsum(n) - n), 0)
    head = tail = np.zeros(len(words), np.uint64)
    for k in range(4):  # affixes of one to four bytes
        own = np.flatnonzero(n > k)
        head, tail = head.copy(), tail.copy()
        head[own] = (head[own] << eight) | flat[first[own] + k]
        tail[own] = (tail[own] << eight) | flat[end[own] - 1 - k]
        yield own, _fold(head[own], 5 + k)
        yield own, _fold(tail[own], 9 + k)
    listed = [(i, k) for i, w in enumerate(words) if w in lexicon for k in lexicon[w]]
    yield np.array([i for i, _ in listed], np.int64), _fold(np.array([k for _, k in listed], np.uint64), 13)


def core(word: str) -> str:
    """The word without the signs and digits around it; empty where it has no letter."""
    if word.isalpha():
        return word
    at = [i for i, c in enumerate(word) if c.isalpha()]
    return word[at[0] : at[-1] + 1] if at else ""


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, list[int]]

    def emissions(self, words: list[str]) -> np.ndarray:
        """exp of the words' scores, the best label's 1."""
        s = np.zeros((len(words), len(self.languages)), np.float32)
        for owner, found in features(words, self.lexicon):
            if len(owner):
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                s[owner[starts]] += np.add.reduceat(self.weights[found], starts)
        return np.exp(np.maximum(s - s.max(1, keepdims=True), -60)).astype(np.float32)


def train(samples: dict[str, list[list[str]]], epochs: int = 6, seed: int = 1) -> Crf:
    """samples: language -> documents as word lists. Conditional log-likelihood by AdaGrad."""
    langs = sorted(k for k, v in samples.items() if any(v))
    n = len(langs)
    rng = np.random.default_rng(seed)
    lexicon: dict[str, list[int]] = {}
    for k, lang in enumerate(langs):
        count: dict[str, int] = {}
        for d in samples[lang]:
            for w in d:
                count[w] = count.get(w, 0) + 1
        for w in sorted(count, key=lambda w: (-count[w], w))[:LEXICON]:
            lexicon.setdefault(w, []).append(k)
    ids: dict[str, int] = {}
    docs = [[np.array([ids.setdefault(w, len(ids)) for w in d], np.int64) for d in samples[lang] if d] for lang in langs]
    owner, found = (np.concatenate(x) for x in zip(*features(list(ids), lexicon)))
    order, each = np.argsort(owner, kind="stable"), np.bincount(owner)
    wide = int(each.max())
    pad = np.full((len(ids), wide), HASHED)
    pad[owner[order], np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)] = found[order]
    words, labels = np.zeros((2, SEQUENCES, STEPS), np.int64)
    for s in range(SEQUENCES):  # spans of one to three languages
        cuts = sorted(rng.choice(np.arange(2, STEPS - 1), rng.integers(0, 3), replace=False)) if n > 1 else []
        for x, y in zip([0, *cuts], [*cuts, STEPS]):
            k = rng.integers(n)
            d = docs[k][rng.integers(len(docs[k]))]
            at = rng.integers(max(1, len(d) - (y - x) + 1))
            words[s, x:y], labels[s, x:y] = np.resize(d[at : at + y - x], y - x), k
    w, a = np.zeros((HASHED + 1, n)), np.zeros((n, n))
    gw, ga = np.full_like(w, 1e-3), np.full_like(a, 1e-3)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(SEQUENCES), SEQUENCES // 250):
            own, want = words[part].T.ravel(), labels[part].T.ravel()
            score = w[pad[own]].sum(1)
            e, t = np.exp(score - score.max(1, keepdims=True)), np.exp(a)
            starts = np.arange(STEPS + 1) * len(part)
            alpha, scale = chain.forward(e, starts, np.ones(n), t)
            beta = chain.backward(e, starts, scale, t)
            miss = np.eye(n)[want] - alpha * beta
            m = len(part)
            right = np.bincount(want[:-m] * n + want[m:], minlength=n * n).reshape(n, n)
            pairs = t * (alpha[:-m].T @ (e[m:] * beta[m:] / scale[m:, None]))
            da = (right - pairs) / m - 1e-3 * a
            used = pad[own].ravel()
            dw = np.stack([np.bincount(used, np.repeat(miss[:, k], wide), HASHED + 1) for k in range(n)], 1) / m - 1e-4 * w
            dw[HASHED] = 0
            gw += dw * dw
            ga += da * da
            w += 0.3 * dw / np.sqrt(gw)
            a += 0.3 * da / np.sqrt(ga)
    return Crf(langs, w[:HASHED].astype(np.float32), a, lexicon)


def fit(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id") -> Crf | None:
    """A model from up to SAMPLE_PER_LANGUAGE labelled documents of each language, chosen by hash; None without any."""
    known = docs.where("lang is not null and text is not null")
    if usable is not None:
        known = known.where(usable)
    known = known.select("lang", "text", F.xxhash64(F.col(id_col), F.lit("sample")).alias("h"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    full = 1 << 30
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(full, int(full * 1.5 * SAMPLE_PER_LANGUAGE / n) + 1)))))
    some = known.where(F.pmod("h", F.lit(full)) < F.element_at(share, F.col("lang")))
    some = some.groupBy("lang", "h", F.xxhash64("text").alias("same")).agg(F.min("text").alias("text"))  # repeated rows once
    samples: dict[str, list[list[str]]] = {}
    for r in sorted(some.collect(), key=lambda r: (r["lang"], r["h"] % full, r["same"])):
        held = samples.setdefault(r["lang"], [])
        if len(held) < SAMPLE_PER_LANGUAGE and (d := [c for x in r["text"].lower().split() if (c := core(x))]):
            held.append(d)
    samples = {k: v for k, v in samples.items() if v}
    return train(samples) if samples else None


class Tagger:
    """Documents' label distributions; emissions of words are kept up to a bound."""

    def __init__(self, model: Crf):
        self.model = model
        self.step = np.exp(model.transitions)
        self.reset()

    def reset(self) -> None:
        self.emit = np.zeros((1024, len(self.model.languages)), np.float32)
        self.ids: dict[str, int] = {}  # of tokens as they stand
        self.cores: dict[str, int] = {}

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """Rows of emit for the tokens that have a letter."""
        ids, cores, new = self.ids, self.cores, []
        split = [t.lower().split() for t in texts]
        for w in set().union(*split).difference(ids):
            c = core(w)
            if c and c not in cores:
                cores[c] = len(cores)
                new.append(c)
            ids[w] = cores[c] if c else -1
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            first = cores[some[0]]
            while len(self.emit) < first + len(some):
                self.emit = np.concatenate([self.emit, np.zeros_like(self.emit)])
            self.emit[first : first + len(some)] = self.model.emissions(some)
        rows = [np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws)) for ws in split]
        return [r[r >= 0] for r in rows]

    def tag(self, texts: list[str | None]) -> np.ndarray:
        """Mean label distribution of each text; zeros where no word has a letter."""
        if len(self.ids) > KEPT_WORDS:
            self.reset()
        chains = self.ids_of([t or "" for t in texts])
        lengths = np.array([len(c) for c in chains])
        out = np.zeros((len(texts), len(self.model.languages)))
        for own in chain.grouped(lengths):
            flat, starts = chain.layout(chains, own)
            e = self.emit[flat].astype(float)
            alpha, scale = chain.forward(e, starts, np.ones(e.shape[1]), self.step)
            marginal = alpha * chain.backward(e, starts, scale, self.step)
            out[own] = chain.per_chain(marginal, starts) / lengths[own, None]
        return out

    def words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, language, probability) for each word with a letter: code-switched text."""
        chain_ids = self.ids_of([text])[0]
        if not len(chain_ids):
            return []
        e, starts = self.emit[chain_ids].astype(float), np.arange(len(chain_ids) + 1)
        alpha, scale = chain.forward(e, starts, np.ones(e.shape[1]), self.step)
        p = alpha * chain.backward(e, starts, scale, self.step)
        named = [w for w in text.lower().split() if has_letter(w)]
        return [(w, self.model.languages[int(k)], float(x)) for w, k, x in zip(named, p.argmax(1), p.max(1))]


def _decide(tagger: Tagger | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    if tagger is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    mean = tagger.tag(texts)
    best = mean.argmax(1)
    top = mean[np.arange(len(mean)), best] if len(mean) else np.zeros(0)
    return [tagger.model.languages[k] if x > 0 else UNKNOWN for k, x in zip(best, top)], [min(1.0, float(x)) for x in top]


def _chunks(texts):
    """Texts of a batch in runs of about CHUNK characters."""
    run, size, first = [], 0, 0
    for i, x in enumerate(texts):
        run.append(x.as_py())
        size += len(run[-1] or "")
        if size > CHUNK:
            yield first, run
            run, size, first = [], 0, i + 1
    if run:
        yield first, run


def identify(docs: DataFrame, model: Crf | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of docs, from whole texts alone.

    A null text, or one without a letter, is `und` with score 0; without a model all are.
    Equal texts get equal answers, an empty table an empty one. A very long text is one
    chain: a worker holds its words and their label distributions. Other columns aren't read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # HASHED * languages floats and LEXICON words a language

    def work(batches):
        tagger = Tagger(held.value) if held.value else None
        for b in batches:
            langs, scores = [], []
            for _, texts in _chunks(b.column(1)):
                x, y = _decide(tagger, texts)
                langs += x
                scores += y
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(given_back(work), "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Crf | None, least: float = 0.5) -> DataFrame:
    """docs, columns as they are, without documents that are `und` or whose score is under `least`.

    A score of 0.5 says that one language holds half of the document's words: texts of
    several languages, none of which does, go, and so do texts without a letter (null and
    empty ones among them). Without a model nothing can be told, and all rows stay.
    Repeated rows share their fate; an empty table gives an empty one; other columns,
    whatever their names, are passed on.
    """
    if model is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def work(batches):
        tagger = Tagger(held.value)
        for b in batches:
            for first, texts in _chunks(b.column(names.index("text"))):  # a run at a time: no second copy of the batch
                keep = [x != UNKNOWN and y >= least for x, y in zip(*_decide(tagger, texts))]
                yield b.slice(first, len(keep)).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(given_back(work), docs.schema)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    done = identify(docs, fit(docs, fold != 1))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return done.select("doc_id", held.alias("held_out"), "lang_pred", "score")
