"""Scaled forward-backward over many chains at once, for the CRF and the HMM."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Places (chains times steps) worked on at once; one longer chain goes alone.
CELLS = 300_000


def grouped(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Chains of like length together, longest first; chains of length 0 left out."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        n = max(1, min(2048, CELLS // int(lengths[order[at]])))
        yield order[at : at + n]
        at += n


def layout(chains: list[np.ndarray], own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of step 0 of all chains, of step 1, ..; start of each step): flat, without padding."""
    lengths = np.array([len(chains[i]) for i in own])
    live = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # chains longer than t
    starts = np.concatenate([[0], np.cumsum(live)])
    flat = np.empty(starts[-1], np.int64)
    for k, i in enumerate(own):
        flat[starts[: lengths[k]] + k] = chains[i]
    return flat, starts


def forward(e: np.ndarray, starts: np.ndarray, start: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha, scales) for emissions e in layout order; the sum of a chain's log scales is its log score."""
    alpha, scale = np.empty_like(e), np.empty(len(e))
    for t in range(len(starts) - 1):
        x, y = starts[t], starts[t + 1]
        if t:
            w = starts[t - 1]
            now = (alpha[w : w + y - x] @ a) * e[x:y]
        else:
            now = start * e[x:y]
        s = now.sum(1)
        scale[x:y] = s
        alpha[x:y] = now / s[:, None]
    return alpha, scale


def backward(e: np.ndarray, starts: np.ndarray, scale: np.ndarray, a: np.ndarray) -> np.ndarray:
    """beta, scaled so that alpha * beta are marginals."""
    beta = np.ones_like(e)
    for t in range(len(starts) - 3, -1, -1):
        x, y, z = starts[t], starts[t + 1], starts[t + 2]
        beta[x : x + z - y] = (e[y:z] * beta[y:z] / scale[y:z, None]) @ a.T
    return beta


def per_chain(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums over each chain's places; chains in the order of the layout."""
    n = starts[1]
    who = np.concatenate([np.arange(y - x) for x, y in zip(starts, starts[1:])])
    if values.ndim == 1:
        return np.bincount(who, values, n)
    return np.stack([np.bincount(who, v, n) for v in values.T], 1)
