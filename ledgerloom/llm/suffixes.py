"""Word-level suffix arrays of a shard of documents, and binary search of test suffixes in them."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np

#: Byte by byte: A-Z become a-z, all else that isn't a digit, a-z or above 0x7F becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


#: Numbers of what is no word of the benchmark; its words come after them.
ITEM_END, UNKNOWN, KNOWN = 0, 1, 2
#: Suffixes that are compared at a time.
SLICE = 100_000


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of ids, in order of their first `depth` words at least.

    As many ranks as fit in 63 bits are joined to one number and sorted, so each round multiplies the sorted depth.
    """
    rank, span, order = ids.astype(np.int64), 1, np.arange(len(ids))
    while span < depth and len(ids):
        bits = max(1, int(rank.max()).bit_length())
        m = min(max(2, 63 // bits), -(-depth // span))
        key = rank.copy()
        for j in range(1, m):
            key <<= bits
            if j * span < len(rank):
                key[: -j * span] |= rank[j * span :]
        order = np.argsort(key)
        key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        span *= m
    return order


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the half-open ranges, and for each the range it is of."""
    n = last - first
    of = np.repeat(np.arange(len(first)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + first[of], of


def bounds(ids: np.ndarray, order: np.ndarray, query: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query (a row of word numbers, of which the first `size` count) where suffixes that begin so start and end in order."""
    if len(query) > SLICE:
        parts = [bounds(ids, order, query[a : a + SLICE], sizes[a : a + SLICE]) for a in range(0, len(query), SLICE)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    width = query.shape[1]
    at, beyond = np.arange(width), np.arange(width) >= sizes[:, None]

    def bound(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(query), dtype=np.int64), np.full(len(query), len(order))
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = (lo[open_] + hi[open_]) // 2
            diff = ids[order[mid][:, None] + at] - query[open_]
            diff[beyond[open_]] = 0
            first = np.argmax(diff != 0, axis=1)
            sign = diff[np.arange(len(open_)), first]
            right = sign <= 0 if upper else sign < 0
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
        return lo

    return bound(False), bound(True)


class Tests:
    """All suffixes of a block of the benchmark, in order of their first `window` words; equal ones are one query.

    Words are numbered from KNOWN; an item ends in ITEM_END, which is less than any word. A query is `whole` for the
    suffixes that are an item of fewer than `window` words.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        self.window, self.number, self.names, parts = window, {}, [], []
        number = defaultdict(count(KNOWN).__next__)
        for name, text in sorted(items, key=lambda x: (x[0], x[1] or "")):
            if w := words(text):
                self.names.append(name)
                parts.append(np.fromiter(map(number.__getitem__, w), np.int32, len(w)))
        self.number = dict(number)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        self.ids = np.full(int((sizes + 1).sum()) + window, ITEM_END, dtype=np.int32)
        for s, p in zip(starts, parts):
            self.ids[s : s + len(p)] = p
        place = np.flatnonzero(self.ids >= KNOWN)
        item = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        left = np.repeat(starts + sizes, sizes) - place  # words up to the item's end
        order = suffix_array(self.ids, window)
        order = order[self.ids[order] >= KNOWN]
        back = np.zeros(len(self.ids), dtype=np.int64)
        back[place] = np.arange(len(place))
        self.order, self.item, left = order, item[back[order]], left[back[order]]
        size = np.minimum(left, window)
        rows = self.ids[order[:, None] + np.arange(window)]
        rows[np.arange(window) >= size[:, None]] = ITEM_END
        new = np.ones(len(order), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        self.first = np.append(np.flatnonzero(new), len(order))
        self.query, self.size = rows[new], size[new]
        self.whole = (left < window) & np.isin(order, starts)


class Shard:
    """Documents gathered until there are enough for one suffix array. Words that no item has are UNKNOWN, as ends are."""

    def __init__(self, tests: Tests) -> None:
        self.tests, self.parts, self.sizes, self.n, self.runs = tests, [], [], 0, {}

    def add(self, text: str | None) -> None:
        w, number = words(text), self.tests.number
        self.parts.append(np.fromiter((number.get(x, UNKNOWN) for x in w), np.int32, len(w)))
        self.sizes.append(len(w))
        self.n += len(w) + 1

    def search(self) -> list[tuple]:
        """For each document: words, hit words, items with an occurrence, then words, start and item of its longest match, then where its hits lie."""
        t, window, sizes = self.tests, self.tests.window, np.array(self.sizes, dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        end = int(starts[-1])
        ids = np.full(end + window, UNKNOWN, dtype=np.int32)
        for s, p in zip(starts, self.parts):
            ids[s : s + len(p)] = p
        order = suffix_array(ids, window)
        order = order[ids[order] >= KNOWN]
        if not len(order) or not len(t.order):
            return [(n, 0, [], 0, -1, None, []) for n in self.sizes]
        lo, hi = bounds(ids, order, t.query, t.size)
        doc_of = lambda p: np.searchsorted(starts, p, side="right") - 1
        full = t.size == window
        whole = np.maximum.reduceat(t.whole, t.first[:-1]) & (hi > lo)
        found = [(full & (hi > lo), None), (whole, t.whole)]
        edge = np.zeros(end + 1, dtype=np.int64)
        items: dict[int, set[int]] = defaultdict(set)
        for some, own in found:
            place, of = ranges(lo[some], hi[some])
            group, place = np.flatnonzero(some)[of], order[place]
            edge += np.bincount(place, minlength=end + 1) - np.bincount(place + t.size[group], minlength=end + 1)
            if own is not None:
                for d, g in np.unique(np.stack([doc_of(place), group], axis=1), axis=0).tolist():
                    members = slice(t.first[g], t.first[g + 1])
                    items[d].update(t.item[members][own[members]].tolist())
            else:
                best = self._runs(place, group, doc_of, starts, items)
        hit = np.cumsum(edge)[:-1] > 0
        n_hit = np.add.reduceat(np.append(hit, False), starts[:-1])
        turn = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        spans = defaultdict(list)
        for d, a, b in zip(doc_of(turn[::2]).tolist(), turn[::2].tolist(), turn[1::2].tolist()):
            spans[d].append((a - int(starts[d]), b - int(starts[d])))
        short = self._short(ids, order, lo, starts)
        out = []
        for d, n in enumerate(self.sizes):
            length, start, item = best.get(d) or short[d]
            name = None if item is None else t.names[item]
            out.append((n, int(n_hit[d]), sorted({t.names[i] for i in items.get(d, ())}), length, start, name, spans.get(d, [])))
        return out

    def _runs(self, place, group, doc_of, starts, items) -> dict[int, tuple]:
        """(words, start, item) of the longest match of each document with a window; its items are added to `items`.

        Windows at neighbouring places are one run. What a run says depends on its windows alone, so equal runs, as of
        text that many documents share, are looked up once.
        """
        by, best = np.argsort(place), {}
        place, group = place[by], group[by]
        cut = np.flatnonzero(np.diff(place) != 1) + 1
        for p, g in zip(np.split(place, cut), np.split(group, cut)) if len(place) else ():
            key = g.tobytes()
            if key not in self.runs:
                self.runs[key] = self._run(g)
            length, offset, item, own = self.runs[key]
            d = int(doc_of(p[0]))
            items[d].update(own)
            mine = (-length, int(p[0] + offset - starts[d]), item)
            best[d] = min(best.get(d, mine), mine)
        return {d: (-n, s, i) for d, (n, s, i) in best.items()}

    def _run(self, group: np.ndarray) -> tuple[int, int, int, list[int]]:
        """Of windows in a row: the longest match's words, place and lowest item, and all items with one of the windows."""
        t = self.tests
        at, i = ranges(t.first[group], t.first[group + 1])
        item, diagonal = t.item[at].astype(np.int64), t.order[at] - i
        by = np.lexsort((i, diagonal))
        i_, item_, diagonal = i[by], item[by], diagonal[by]
        new = np.ones(len(by), dtype=bool)
        new[1:] = (diagonal[1:] != diagonal[:-1]) | (i_[1:] != i_[:-1] + 1)
        head = np.flatnonzero(new)
        run = np.diff(np.append(head, len(by)))
        n, start, name = min(zip((-run).tolist(), i_[head].tolist(), item_[head].tolist()))
        return t.window - n - 1, start, name, np.unique(item).tolist()

    def _short(self, ids, order, lo, starts) -> list[tuple]:
        """(words, start, item) of each document's longest match of up to `window` words, by the queries next to each suffix."""
        t, width, match = self.tests, np.arange(self.tests.window), np.zeros(int(starts[-1]) + 1, dtype=np.int64)
        for a in range(0, len(order), SLICE):
            own = order[a : a + SLICE]
            rows, before = ids[own[:, None] + width], np.searchsorted(lo, np.arange(a, a + len(own)), side="right") - 1
            for near in (before, before + 1):
                same = rows == t.query[np.clip(near, 0, len(t.query) - 1)]
                match[own] = np.maximum(match[own], np.where(same.all(axis=1), len(width), np.argmin(same, axis=1)))
        longest = np.maximum.reduceat(match, starts[:-1])
        doc = np.flatnonzero(longest > 0)
        of = np.repeat(np.arange(len(longest)), np.diff(starts))
        best = np.flatnonzero((match[:-1] == longest[of]) & (match[:-1] > 0))
        place = best[np.unique(of[best], return_index=True)[1]]
        out = [(0, -1, None)] * len(longest)
        if len(doc):
            a, b = bounds(t.ids, t.order, ids[place[:, None] + width], longest[doc])
            item = np.minimum.reduceat(np.append(t.item, len(t.names)), np.stack([a, b], axis=1).ravel())[::2]
            for d, p, i in zip(doc.tolist(), place.tolist(), item.tolist()):
                out[d] = (int(longest[d]), p - int(starts[d]), i)
        return out
