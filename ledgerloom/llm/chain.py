"""Classifier chains in numpy: logistic models over features that a document has, each fed with the earlier probabilities."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Features that each model looks at, and documents of the sample that one must be in.
MOST_FEATURES, LEAST_DOCS = 3000, 5


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Bags:
    """Documents as the numbers of their features, each document's together."""

    def __init__(self, docs: list[np.ndarray]) -> None:
        self.sizes = np.array([len(d) for d in docs], dtype=np.int64)
        self.row = np.repeat(np.arange(len(docs)), self.sizes)
        self.col = np.concatenate([np.zeros(0, dtype=np.int64), *docs]).astype(np.int64)
        self.n = len(docs)

    def only(self, docs: np.ndarray) -> Bags:
        starts, out = np.cumsum(self.sizes) - self.sizes, Bags([])
        at = np.repeat(starts[docs] - (np.cumsum(self.sizes[docs]) - self.sizes[docs]), self.sizes[docs]) + np.arange(self.sizes[docs].sum())
        out.sizes, out.n, out.col = self.sizes[docs], len(docs), self.col[at]
        out.row = np.repeat(np.arange(out.n), out.sizes)
        return out

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.col], self.n) if self.n else np.zeros(0)


def gaps(n: np.ndarray, pos: np.ndarray, docs: int, positive: int) -> np.ndarray:
    """How much more or less often a feature is in positive documents than in others, by its standard error."""
    gap = np.abs((pos + 0.5) / (positive + 1) - (n - pos + 0.5) / (docs - positive + 1)) / np.sqrt((n + 1) / max(1, docs))
    return np.where(n >= LEAST_DOCS, gap, -1.0)


@dataclass
class Linear:
    """bias + weight of each feature that is there + weight of each earlier probability."""

    bias: float
    weights: np.ndarray
    earlier: np.ndarray

    @classmethod
    def fit(cls, bags: Bags, features: int, earlier: np.ndarray, y: np.ndarray, steps: int = 150, decay: float = 2e-4) -> Linear:
        """By Adam on all documents. With one label only, the bias alone says it."""
        n, e = len(y), earlier.shape[1]
        if not n or y.min() == y.max():
            return cls(6.0 if n and y[0] else -6.0, np.zeros(features), np.zeros(e))
        gap = gaps(np.bincount(bags.col, minlength=features), np.bincount(bags.col, y[bags.row], features), n, int(y.sum()))
        chosen = np.argsort(-gap, kind="stable")[:MOST_FEATURES]
        chosen = np.sort(chosen[gap[chosen] >= 0])
        number = np.full(features, -1)
        number[chosen] = np.arange(len(chosen))
        kept = number[bags.col] >= 0
        row, col, k = bags.row[kept], number[bags.col[kept]], len(chosen)
        theta, m, v = np.zeros(k + e + 1), np.zeros(k + e + 1), np.zeros(k + e + 1)
        for step in range(1, steps + 1):
            err = (_sigmoid(np.bincount(row, theta[col], n) + earlier @ theta[k : k + e] + theta[-1]) - y) / n
            g = np.concatenate([np.bincount(col, err[row], k), earlier.T @ err, [err.sum()]])
            g[:-1] += decay * theta[:-1]
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights = np.zeros(features)
        weights[chosen] = theta[:k]
        return cls(float(theta[-1]), weights, theta[k : k + e])

    def predict(self, bags: Bags, earlier: np.ndarray) -> np.ndarray:
        return _sigmoid(bags.sums(self.weights) + earlier @ self.earlier + self.bias)


def fit(bags: Bags, features: int, y: np.ndarray, folds: np.ndarray) -> tuple[list[Linear], np.ndarray]:
    """One model for each column of y, and the probabilities that models of other folds gave: later ones learn from these."""
    chain, earlier = [], np.zeros((bags.n, 0))
    for c in range(y.shape[1]):
        chain.append(Linear.fit(bags, features, earlier, y[:, c]))
        out = np.zeros(bags.n)
        for rest, own in splits(folds):
            model = Linear.fit(bags.only(rest), features, earlier[rest], y[rest, c])
            out[own] = model.predict(bags.only(own), earlier[own])
        earlier = np.column_stack([earlier, out])
    return chain, earlier


def splits(folds: np.ndarray):
    """(documents of other folds, documents of the fold); a single fold is its own other one."""
    for f in np.unique(folds):
        rest, own = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
        yield (rest if len(rest) else own), own


def predict(chain: list[Linear], bags: Bags) -> np.ndarray:
    earlier = np.zeros((bags.n, 0))
    for model in chain:
        earlier = np.column_stack([earlier, model.predict(bags, earlier)])
    return earlier


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The middle between the two neighbouring probabilities at which F1 is best; 0.5 without both labels."""
    if not len(y) or y.min() == y.max():
        return 0.5
    by = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[by])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    f1[:-1][p[by][1:] == p[by][:-1]] = -1  # equal probabilities aren't parted
    k = int(np.argmax(f1))
    return float((p[by][k] + (p[by][k + 1] if k + 1 < len(p) else 0.0)) / 2)
