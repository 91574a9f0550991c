"""Word shingles of texts as sorted 64-bit hashes, their MinHash values, and pairs that may be similar."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import xxhash

from .backoff import joined

#: MinHash values for each text; the first BANDS * ROWS of them are the bands.
HASHES, BANDS, ROWS = 96, 20, 4
#: Values that one step of the comparison looks at.
STEP = 16
#: Words whose hashes each worker process keeps.
_KEPT_WORDS = 250_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        x = self[word] = xxhash.xxh3_64_intdigest(word)
        return x


_WORDS = _Hashes()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of `size` words in a row, A-Z lower-cased; a text of fewer words, but not none, is one shingle."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, w), np.uint64, len(w))
    take = min(size, len(w))
    out = np.full(len(h) - take + 1, np.uint64(take))
    for k in range(take):
        out = joined(out, h[k : len(h) - take + 1 + k])
    return np.unique(out)


@lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_011)
    return rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (one row for each set; none is empty), as 32-bit numbers."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), HASHES), dtype=np.uint32)
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(zip(*_multipliers())):
            out[:, k] = np.minimum.reduceat(flat * a + b, starts)
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band: what its values and its number give."""
    v = values[:, : BANDS * ROWS].reshape(len(values), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), v.shape[:2])
    for r in range(ROWS):
        key = joined(np.ascontiguousarray(key), v[:, :, r])
    return key.view(np.int64)


def short(values: np.ndarray) -> np.ndarray:
    """The lowest 8 bits of a mixed value: two differing values agree in them one time in 256."""
    return ((values * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """After each step, the fewest agreeing values for which similarity may still reach the threshold.

    With a uniform prior, the posterior after m of n agreements is Beta(m + 1, n - m + 1), and its mass from t up is the
    chance of at most m successes in n + 1 trials of chance t. Below `tolerance` the pair is dropped.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def survivors(sig: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, tolerance: float, slice_: int = 200_000) -> np.ndarray:
    """Which of the pairs of rows the comparison, step by step, doesn't drop."""
    least, out = least_matches(threshold, tolerance), []
    for at in range(0, len(i), slice_):
        live = np.arange(at, min(at + slice_, len(i)))
        same = np.zeros(len(live), dtype=np.int32)
        for k, need in enumerate(least):
            cut = slice(k * STEP, (k + 1) * STEP)
            same += (sig[i[live], cut] == sig[j[live], cut]).sum(axis=1, dtype=np.int32)
            keep = same >= need
            live, same = live[keep], same[keep]
        out.append(live)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row that pairs lead to."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


#: A shingle of more rows than this is counted by a matrix product, one of fewer by its pairs.
DENSE = 64


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Shingles that each pair of sets shares, as a matrix."""
    m = len(sets)
    out = np.zeros((m, m), dtype=np.int32)
    _, shingle, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    keep = n[shingle] >= 2
    shingle, row = shingle[keep], row[keep]
    dense = n[shingle] > DENSE
    if dense.any():
        _, col = np.unique(shingle[dense], return_inverse=True)
        own = row[dense]
        for at in range(0, int(col.max()) + 1, 4096):
            x = np.zeros((m, min(4096, int(col.max()) + 1 - at)), dtype=np.float32)
            some = (col >= at) & (col < at + 4096)
            x[own[some], col[some] - at] = 1
            out += (x @ x.T).astype(np.int32)
    by = np.argsort(shingle[~dense], kind="stable")
    own, size = row[~dense][by], n[shingle[~dense][by]]
    for d in np.unique(size):
        group = own[size == d].reshape(-1, d)
        a, b = np.triu_indices(d, 1)
        pair = (group[:, a].astype(np.int64) * m + group[:, b]).ravel()
        which, times = np.unique(pair, return_counts=True)
        out[which // m, which % m] += times
        out[which % m, which // m] += times
    return out
