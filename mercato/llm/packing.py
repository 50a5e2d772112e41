"""Packing pieces into windows by non-negative least squares.

Shallow combinations of lengths that fill the window exactly are the columns, their
repeat counts the unknowns, the histogram of piece lengths the right-hand side. The
solution is rounded within what is there, and the rest is packed greedily. Only the
histogram (at most `window` counts) reaches the driver; pieces find their place by their
rank among the pieces of their length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mercato.llm.memory import given_back
from mercato.llm.tokens import pieces
from mercato.operators.ranking import rank_in_group
from mercato.session import cut, table

WINDOW = 1024
BUCKETS = 64


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Pairs and triples of the given lengths that fill the window; zero where a pair has no third."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    out = []
    for a in lengths[lengths <= window // 2]:
        if there[window - a]:
            out.append(np.array([[a, window - a, 0]]))
        b = lengths[(lengths >= a) & (lengths <= (window - a) // 2)]
        b = b[there[window - a - b]]
        out.append(np.stack([np.full(len(b), a), b, window - a - b], 1))
    return np.concatenate(out) if out else np.zeros((0, 3), int)


def nnls(cols: np.ndarray, want: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that minimises |A x - want|, by accelerated projected gradients; column j of A counts the lengths in cols[j]."""
    n = len(want)
    real = (cols > 0).astype(float)
    up = lambda x: np.bincount(cols.ravel(), (real * x[:, None]).ravel(), n)
    down = lambda r: (r[cols] * real).sum(1)
    v = np.ones(len(cols))
    for _ in range(30):
        v = down(up(v))
        v /= max(np.linalg.norm(v), 1e-300)
    step = 1 / (1.05 * np.linalg.norm(down(up(v))) + 1e-9)
    x = y = np.zeros(len(cols))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * down(up(y) - want))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a window, repeats) that use every piece exactly once."""
    left = np.zeros(window + 1, np.int64)
    for k, v in histogram.items():
        left[k] += v
    out = []

    def use(lengths: tuple[int, ...], times: int) -> None:
        out.append((lengths, times))
        for k in lengths:
            left[k] -= times

    if left[window]:
        use((window,), int(left[window]))
    cols = combinations(np.flatnonzero(left), window)
    if len(cols):
        x = nnls(cols, left.astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            lengths = tuple(int(k) for k in cols[j] if k)
            times = min(int(x[j] + 0.5), *(int(left[k]) // lengths.count(k) for k in set(lengths)))
            if times > 0:
                use(lengths, times)
    while left.any():  # longest first, then the longest that still fits
        own: list[int] = []
        room = window
        held = left.copy()
        while fits := int(np.flatnonzero(held[: room + 1])[-1]) if held[1 : room + 1].any() else 0:
            own.append(fits)
            held[fits] -= 1
            room -= fits
        use(tuple(own), min(int(left[k]) // own.count(k) for k in set(own)))
    return out


def places(planned: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, sequence of that rank, offset in the sequence), ascending."""
    out: dict[int, list] = {}
    seen: dict[int, int] = {}
    sequence = 0
    for lengths, times in planned:
        offset = 0
        for k in lengths:
            out.setdefault(k, []).append((seen.get(k, 0), sequence, offset))
            seen[k] = seen.get(k, 0) + times
            offset += k
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids, an end id last, are cut at every `window` ids; only its last piece
    may be shorter. Null and empty texts are the end id alone. Repeated rows are packed
    as often as they occur. An empty table gives no rows. Only doc_id and text are read.
    """
    cuts = cut(pieces(docs, window, path).withColumn("bucket", F.pmod("part", F.lit(BUCKETS))))
    histogram = {r["length"]: r["n"] for r in cuts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = places(plan(histogram, window))

    def work(batches):
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros((2, len(length)), np.int64)
            for k in np.unique(length):
                m, rows = length == k, where[int(k)]
                at = np.searchsorted(rows[:, 0], rank[m], "right") - 1
                sequence[m], offset[m] = rows[at, 1] + rank[m] - rows[at, 0], rows[at, 2]
            keep = [b.column(b.schema.get_field_index(c)) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    ranked = rank_in_group(cuts, "length", "bucket", ["part", "at"])
    return ranked.mapInArrow(given_back(work), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
