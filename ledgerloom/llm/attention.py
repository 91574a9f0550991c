"""Attention-based multiple-instance learning in numpy: passages are instances, documents are bags."""

from __future__ import annotations

import numpy as np

#: Words of a passage.
PASSAGE = 64
#: Bytes that are told apart: each ASCII one, and all others as one. The model learns what they mean.
BYTES = 129
FEATURES = BYTES + 6


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of all texts, and how many each text has (one of zeros for a text without words).

    Shares of bytes, mean word length, distinct words, words equal to the one before or to the one before that, words
    without a-z that have two or more A-Z, words with an ASCII byte that is no letter or digit, and how full the passage is.
    """
    number: dict[bytes, int] = {}
    words, ids, counts = [], [], []
    for t in texts:
        w = (t or "").encode().split()
        words += w
        ids += [number.setdefault(x, len(number)) for x in w]
        counts.append(len(w))
    counts = np.array(counts, dtype=np.int64)
    n_pass = np.maximum(1, -(-counts // PASSAGE))
    out = np.zeros((int(n_pass.sum()), FEATURES), dtype=np.float32)
    if not words:
        return out, n_pass
    first_pass = np.cumsum(n_pass) - n_pass
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    of = np.repeat(first_pass, counts) + place // PASSAGE
    size = np.fromiter(map(len, words), np.int64, len(words))
    byte = np.minimum(np.frombuffer(b"".join(words), np.uint8), BYTES - 1).astype(np.int64)
    word_of = np.repeat(np.arange(len(words)), size)
    in_word = lambda some: np.bincount(word_of[some], minlength=len(words))
    lower, upper, digit = (byte >= 97) & (byte <= 122), (byte >= 65) & (byte <= 90), (byte >= 48) & (byte <= 57)
    marks = in_word(~(lower | upper | digit) & (byte < BYTES - 1))
    n = len(out)
    total = lambda x: np.bincount(of, weights=x, minlength=n)
    n_words = np.maximum(1, total(np.ones(len(words))))
    by_pass = np.bincount(of[word_of] * BYTES + byte, minlength=n * BYTES).reshape(n, BYTES)
    out[:, :BYTES] = by_pass / np.maximum(1, by_pass.sum(axis=1, keepdims=True))
    ids = np.array(ids)
    again, again2 = np.zeros(len(ids)), np.zeros(len(ids))
    again[1:] = (ids[1:] == ids[:-1]) & (of[1:] == of[:-1])
    again2[2:] = (ids[2:] == ids[:-2]) & (of[2:] == of[:-2])
    different = np.bincount(np.unique(of * len(number) + ids) // len(number), minlength=n)
    out[:, BYTES] = np.minimum(1, total(size) / n_words / 20)
    out[:, BYTES + 1] = different / n_words
    out[:, BYTES + 2] = total(np.maximum(again, again2)) / n_words
    out[:, BYTES + 3] = total((in_word(upper) >= 2) & (in_word(lower) == 0)) / n_words
    out[:, BYTES + 4] = total(marks > 0) / n_words
    out[:, BYTES + 5] = np.minimum(1, n_words / PASSAGE)
    return out, n_pass


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """h = tanh(Wx + b); attention = softmax over a document of w . (tanh(Vh) * sigmoid(Uh)); p = sigmoid(c . sum + d)."""

    def __init__(self, params: dict[str, np.ndarray]) -> None:
        self.p = params

    @classmethod
    def fit(cls, x: np.ndarray, n_pass: np.ndarray, y: np.ndarray, hidden: int = 12, gate: int = 8, epochs: int = 40, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> GatedAttention:
        """By Adam over batches of whole documents. Without both labels, the score is the share of label 1 or 0.5."""
        rng = np.random.default_rng(seed)
        mean, std = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-2)
        p = {"W": rng.normal(0, 0.4, (x.shape[1], hidden)), "b": np.zeros(hidden), "V": rng.normal(0, 0.4, (hidden, gate)), "U": rng.normal(0, 0.4, (hidden, gate)), "w": rng.normal(0, 0.4, gate), "c": rng.normal(0, 0.4, hidden), "d": np.zeros(1)}
        m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
        model = cls(p | {"mean": mean, "std": std})
        start = np.cumsum(n_pass) - n_pass
        x = (x - mean) / std
        for epoch in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(order), 256):
                docs = order[at : at + 256]
                sizes = n_pass[docs]
                rows = np.repeat(start[docs] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                grads = model._grads(x[rows], sizes, y[docs])
                step += 1
                for k, g in grads.items():
                    g = g + decay * p[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    p[k] -= rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
                model.p.update(p)
        return model

    def _forward(self, x, sizes):
        p, start = self.p, np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(sizes)), sizes)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, start)[of])
        a = e / np.add.reduceat(e, start)[of]
        z = np.add.reduceat(a[:, None] * h, start)
        return of, start, h, t, s, a, z, _sigmoid(z @ p["c"] + p["d"][0])

    def _grads(self, x, sizes, y):
        p = self.p
        of, start, h, t, s, a, z, out = self._forward(x, sizes)
        err = (out - y) / len(y)
        dz = err[:, None] * p["c"]
        da = (dz[of] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, start)[of])
        dt, ds = de[:, None] * p["w"] * s * (1 - t * t), de[:, None] * p["w"] * t * s * (1 - s)
        dh = a[:, None] * dz[of] + dt @ p["V"].T + ds @ p["U"].T
        du = dh * (1 - h * h)
        return {"W": x.T @ du, "b": du.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": de @ (t * s), "c": err @ z, "d": np.array([err.sum()])}

    def score(self, x: np.ndarray, n_pass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of label 1 of each document, and the highest attention that one of its passages has."""
        _, start, _, _, _, a, _, out = self._forward((x - self.p["mean"]) / self.p["std"], n_pass)
        return out, np.maximum.reduceat(a, start)
