"""Fitting a learned partition index: neighbour graph, balanced partitioning,
classifier.  Plain arrays over a bounded sample; used by ``neighbours``."""

from __future__ import annotations

import numpy as np


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row by inner product, (n, k)."""
    n = len(x)
    k = min(k, n - 1)
    out = np.zeros((n, k), dtype=np.int64)
    for i in range(0, n, 1024):
        s = x[i:i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else out[i:i + 1024]
    return out


def _smooth(v: np.ndarray, a: np.ndarray, b: np.ndarray, degree: np.ndarray) -> np.ndarray:
    """Each vertex's value averaged with its neighbours'."""
    total = np.bincount(a, weights=v[b], minlength=len(v)) + np.bincount(b, weights=v[a], minlength=len(v))
    return 0.5 * v + 0.5 * total / degree


def bisect(a: np.ndarray, b: np.ndarray, n: int, share: float, rng: np.random.Generator) -> np.ndarray:
    """Splits n vertices with edges (a, b) in two, ``share`` of them on the
    false side, few edges between: the second smoothest vector, cut at its
    quantile, then swaps that cut fewer edges."""
    degree = np.maximum(1, np.bincount(a, minlength=n) + np.bincount(b, minlength=n))
    v = rng.standard_normal(n)
    for _ in range(60):
        v = _smooth(v, a, b, degree)
        v -= (v * degree).sum() / degree.sum()
        v /= np.linalg.norm(v) or 1
    side = np.zeros(n, dtype=bool)
    side[np.argsort(v, kind="stable")[round(share * n):]] = True
    for _ in range(12):
        sign = np.where(side, 1.0, -1.0)
        pull = np.bincount(a, weights=sign[b], minlength=n) + np.bincount(b, weights=sign[a], minlength=n)
        gain = -pull * sign  # edges saved by changing sides
        up, down = np.flatnonzero(~side), np.flatnonzero(side)
        up, down = up[np.argsort(-gain[up], kind="stable")], down[np.argsort(-gain[down], kind="stable")]
        m = min(len(up), len(down))
        good = int(((gain[up[:m]] + gain[down[:m]]) > 0).sum()) // 2
        if not good:
            break
        side[up[:good]], side[down[:good]] = True, False
    return side


def balanced_partition(graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part of each vertex; parts differ in size by rounding only."""
    n = len(graph)
    rng = np.random.default_rng(seed)
    out = np.zeros(n, dtype=np.int64)
    todo = [(np.arange(n), 0, parts)]
    place = np.full(n, -1, dtype=np.int64)
    while todo:
        own, first, m = todo.pop()
        out[own] = first
        if m < 2 or len(own) < 2:
            continue
        place[:] = -1
        place[own] = np.arange(len(own))
        a = np.repeat(np.arange(len(own)), graph.shape[1])
        b = place[graph[own]].reshape(-1)
        side = bisect(a[b >= 0], b[b >= 0], len(own), (m // 2) / m, rng)
        todo += [(own[~side], first, m // 2), (own[side], first + m // 2, m - m // 2)]
    return out


def train_classifier(x: np.ndarray, target: np.ndarray, epochs: int = 60, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression (weights, bias) on soft labels ``target`` (n, parts)."""
    rng = np.random.default_rng(seed)
    d, m = x.shape[1], target.shape[1]
    w, b = np.zeros((d, m)), np.zeros(m)
    mom = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 256):
            at = order[i:i + 256]
            p = probabilities(x[at], (w, b)) - target[at]
            step += 1
            for v, g, k in ((w, x[at].T @ p / len(at), 0), (b, p.mean(axis=0), 2)):
                mom[k] += 0.1 * (g - mom[k])
                mom[k + 1] += 0.01 * (g * g - mom[k + 1])
                v -= 0.05 * (mom[k] / (1 - 0.9 ** step)) / (np.sqrt(mom[k + 1] / (1 - 0.99 ** step)) + 1e-8)
    return w, b


def probabilities(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    s = x @ model[0] + model[1]
    s = np.exp(s - s.max(axis=1, keepdims=True))
    return s / s.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, parts: int, k: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Classifier of the balanced parts of the sample's neighbour graph.  A
    row's label is spread over the parts of its neighbours and its own."""
    parts = max(1, min(parts, len(x)))
    unit = x / np.maximum(1e-300, np.linalg.norm(x, axis=1, keepdims=True))
    graph = neighbour_graph(unit, k)
    part = balanced_partition(graph, parts)
    target = np.zeros((len(x), parts))
    near = np.concatenate([np.arange(len(x))[:, None], graph], axis=1)
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].reshape(-1)), 1 / near.shape[1])
    return train_classifier(unit, target)
