"""Which of some figures add up to another: all sums at once on a grid of whole steps, and matchings without enumeration."""

from __future__ import annotations

import numpy as np


def unit_of(values: list[float]) -> float:
    """The largest power of ten, from cents on, of which all figures are multiples; 0 if they aren't even of cents."""
    cents = [round(v * 100) for v in values]
    if any(abs(v * 100 - c) > 1e-6 * max(1.0, abs(v)) for v, c in zip(values, cents)):
        return 0.0
    unit = 1
    while any(cents) and all(c % (unit * 10) == 0 for c in cents):
        unit *= 10
    return unit / 100


class Sums:
    """All sums of some positive figures up to a largest one.

    Sums are those of figures rounded to steps. Where the figures are multiples of a unit that is at least as coarse, a step is that
    unit and sums are exact; else a step is the tolerance over twice the number of figures, so a sum is off by a quarter of the
    tolerance at most. Time and memory grow with figures times steps, whatever the number of sums: a byte for each step, and a
    bit for each step and figure.
    """

    def __init__(self, values: list[float], largest: float, tolerance: float) -> None:
        unit, fine = unit_of(values), tolerance / (2 * max(1, len(values)))
        self.step = max(unit, fine) or 1.0
        self.tolerance = tolerance
        self.values = [int(round(v / self.step)) for v in values]
        self.size = int(np.floor((largest + tolerance) / self.step + 0.5)) + 1
        #: The fewest figures that make each sum; 255 where none do.
        self.fewest = np.full(self.size, 255, dtype=np.uint8)
        self.fewest[0] = 0
        self.used: list[np.ndarray | None] = []
        for v in self.values:
            if not 0 < v < self.size:
                self.used.append(None)
                continue
            more = self.fewest[:-v].copy()
            np.add(more, 1, out=more, where=more < 254)
            better = more < self.fewest[v:]
            self.used.append(np.packbits(better))
            np.minimum(self.fewest[v:], more, out=self.fewest[v:])

    def smallest(self, target: float, least: int = 1, most: int | None = None) -> list[int] | None:
        """Places of the fewest figures, between least and most of them, whose sum is within tolerance of target; of those the nearest sum."""
        low, high = (int(np.floor((target + s * self.tolerance) / self.step + 0.5)) for s in (-1, 1))
        if target < 0 or low >= self.size:
            return None
        cells = np.arange(max(0, low), min(high, self.size - 1) + 1)
        cells = cells[np.abs(cells * self.step - target) <= self.tolerance + 1e-9 * self.step]
        n = self.fewest[cells]
        fits = (n >= least) & (n < 254) & (n <= (most if most is not None else 253))
        if not fits.any():
            return None
        cells, n = cells[fits], n[fits]
        cells = cells[n == n.min()]
        at, out = int(cells[np.abs(cells * self.step - target).argmin()]), []
        for i in range(len(self.values) - 1, -1, -1):
            used, v = self.used[i], self.values[i]
            if used is not None and at >= v and used[(at - v) >> 3] >> (7 - ((at - v) & 7)) & 1:
                out.append(i)
                at -= v
        return out[::-1]


#: Steps that a grid may have, and figures whose sums are met in the middle where that is less work: at most 2^22 for a half.
MOST_STEPS, HALVED = 100_000_000, 44


def _noise(values: list[float]) -> float:
    """By how much a sum of figures may be off in binary: some last places of the largest sum, so that a tolerance isn't widened by large figures."""
    return 4 * (len(values) + 1) * float(np.finfo(float).eps) * sum(map(abs, values))


def _steps(values: list[float], target: float, tolerance: float) -> float:
    return (max(target, 0.0) + tolerance) / (max(unit_of(values), tolerance / (2 * max(1, len(values)))) or 1.0)


def _halves(values: list[float]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sums, masks and numbers of figures of all sets of the even places and of the odd ones."""
    out = []
    for first in (0, 1):
        sums, masks, count = np.zeros(1), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        for i in range(first, len(values), 2):
            sums, masks, count = np.concatenate([sums, sums + values[i]]), np.concatenate([masks, masks | (1 << i)]), np.concatenate([count, count + 1])
        out.append((sums, masks, count))
    return out


def fewest(values: list[float], target: float, tolerance: float, least: int = 1, most: int | None = None) -> list[int] | None:
    """Places of the fewest positive figures, between least and most, that add up to target; of sets of one size the nearest sum.

    All sets of two halves that meet, or a grid where that is less work. More than MOST_STEPS steps for more than HALVED figures are
    not searched: that raises an error.
    """
    steps, most = _steps(values, target, tolerance), len(values) if most is None else most
    if len(values) > HALVED or 2 ** (len(values) / 2) > steps:
        if steps > MOST_STEPS:
            raise ValueError(f"{len(values)} figures on a grid of {steps:.0f} steps")
        return Sums(values, max(target, 0.0), tolerance).smallest(target, least, most)
    (sa, ma, ca), (sb, mb, cb) = _halves(values)
    room, best = tolerance + _noise([*values, target]), None
    for k in range(int(cb.max()) + 1):
        own = np.flatnonzero(cb == k)
        own = own[np.argsort(sb[own], kind="stable")]
        for side in (0, -1):  # the sums next to what is missing, from above and from below
            at = np.searchsorted(sb[own], target - sa) + side
            ok = (at >= 0) & (at < len(own))
            i, j = np.flatnonzero(ok), own[at[ok]]
            off, n = np.abs(sa[i] + sb[j] - target), ca[i] + k
            fit = np.flatnonzero((off <= room) & (n >= least) & (n <= most))
            if len(fit):
                first = fit[np.lexsort((ma[i[fit]] | mb[j[fit]], off[fit], n[fit]))[0]]
                found = (int(n[first]), float(off[first]), int(ma[i[first]] | mb[j[first]]))
                best = found if best is None or found < best else best
    return None if best is None else [x for x in range(len(values)) if best[2] >> x & 1]


def reaches(values: list[float], target: float, tolerance: float) -> bool | None:
    """Whether some of the positive figures add up to target. None: too many of too fine figures."""
    if target < -tolerance:
        return False
    try:
        return fewest(values, max(target, 0.0), tolerance, 0) is not None
    except ValueError:
        return None


def signed_reach(start: float, changes: list[float], end: float, tolerance: float) -> bool | None:
    """Whether start with each change added or taken away can be end; None if it can't be told.

    A change either way is the lowest sum, all taken away, with twice the change for each one that is added.
    """
    sizes = [abs(x) for x in changes if x]
    return reaches([2 * x for x in sizes], end - start + sum(sizes), tolerance)


def only_matching(allowed: list[list[int]]) -> list[int] | None:
    """The one way to give each left item a right item of its own among those allowed to it; None if there is none or another."""

    def augment(i: int, seen: set[int], owner: dict[int, int], without: tuple[int, int] | None) -> bool:
        for j in allowed[i]:
            if j not in seen and (i, j) != without:
                seen.add(j)
                if j not in owner or augment(owner[j], seen, owner, without):
                    owner[j] = i
                    return True
        return False

    owner: dict[int, int] = {}
    if not all(augment(i, set(), owner, None) for i in range(len(allowed))):
        return None
    for j, i in list(owner.items()):
        other = {b: a for b, a in owner.items() if b != j}
        if augment(i, set(), other, (i, j)):
            return None
    return [j for _, j in sorted((i, j) for j, i in owner.items())]
