"""A weighted backoff automaton over the n-grams of one block of documents."""

from __future__ import annotations

import numpy as np
import xxhash

#: No word holds a space, so these stand for the end and the beginning of a document.
END, BEGIN = b" ", b"  "
#: Tokens of a document that are read in a row where many are read side by side.
LANE = 512


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def joined(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of histories with one more word."""
    with np.errstate(over="ignore"):
        x = history * np.uint64(0x9E3779B97F4A7C15) + (word ^ np.uint64(0xD6E8FEB86659FD93))
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        return x ^ (x >> np.uint64(31))


class Grams:
    """The k-grams that end at each token of a block, for k from 1 to `order`; a document's history starts with BEGIN."""

    def __init__(self, tokens: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, order: int) -> None:
        self.order = order
        self.start = np.cumsum(sizes) - sizes
        place = np.arange(len(tokens), dtype=np.int32) - np.repeat(self.start.astype(np.int32), sizes)
        word, begin = hashes[tokens], np.uint64(word_hash(BEGIN))
        self.hash, self.index, self.whole = [], [], []
        at = word.copy()
        for k in range(1, order + 1):
            if k > 1:  # the (k-1)-gram that ended one token before, or the beginning itself
                before = np.empty_like(at)
                before[1:] = at[:-1]
                before[place == 0] = begin
                at = np.where(place >= k - 2, joined(before, word), at)
            unique, inverse = np.unique(at, return_inverse=True)
            self.hash.append(unique)
            self.index.append(inverse.astype(np.int32))
            self.whole.append(place >= k - 2 if k > 1 else np.ones(len(at), dtype=bool))

    def counted(self, train: np.ndarray) -> list[np.ndarray]:
        """How often each k-gram ends at a token that trains."""
        return [np.bincount(i[train & w], minlength=len(h)) for h, i, w in zip(self.hash, self.index, self.whole)]


ROOT, FIRST = 0, 1


class Automaton:
    """Numbered states, one for each history that training has, with an arc table and a failure table.

    State ROOT is the empty history, FIRST the beginning of a document; others are the k-grams of the block, for k below
    the order. An arc of a k-gram leads from its history and weighs log10 of (c(gram) + mu * p(shorter)) / (c(history) +
    mu); a state's failure arc leads to its history without the first word and weighs log10 of mu / (c(history) + mu).
    The root has an arc for every word, also for unknown ones. An arc's target is the longest history it ends in. The
    arcs of a state, with what its failure arc leads to, give a distribution over all words and the end.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], documents: int, tokens: int, words: int, mu: float) -> None:
        self.grams, order, n = grams, grams.order, len(grams.index[0])
        sizes = [len(h) for h in grams.hash[: order - 1]]
        offset = np.cumsum([FIRST + 1, *sizes])
        self.words, states = len(grams.hash[0]), int(offset[-1])
        self.fail, self.fail_weight = np.full(states, ROOT, dtype=np.int32), np.zeros(states)
        self.fail_weight[FIRST] = np.log10(mu / (documents + mu))
        p = (counts[0] + 1) / (tokens + words + 1)
        self.root_weight = np.log10(p)
        self.root_target = np.where(counts[0] > 0, FIRST + 1 + np.arange(self.words), ROOT).astype(np.int32) if order > 1 else np.full(self.words, ROOT, dtype=np.int32)
        keys, weights, targets = [np.zeros(0, dtype=np.int64)], [np.zeros(0)], [np.zeros(0, dtype=np.int32)]
        begins = np.zeros(n, dtype=bool)
        begins[grams.start] = True
        for k in range(2, order + 1):
            index, shorter = grams.index[k - 1], grams.index[k - 2]
            some = np.zeros(len(counts[k - 1]), dtype=np.int64)
            some[index] = np.arange(n)  # a token at which the k-gram ends
            first, before = begins[some], some - 1  # a k-gram that begins a document has no token before its history's end
            history = np.where(first, documents, counts[k - 2][shorter[before]])
            p = (counts[k - 1] + mu * p[shorter[some]]) / (history + mu)
            seen = np.flatnonzero(counts[k - 1] > 0)
            source = np.where(first, FIRST, offset[k - 2] + shorter[before])[seen]
            keys.append(source.astype(np.int64) * self.words + grams.index[0][some[seen]])
            weights.append(np.log10(p[seen]))
            targets.append((offset[k - 1] + seen if k < order else offset[k - 2] + shorter[some[seen]]).astype(np.int32))
            own = slice(int(offset[k - 2]), int(offset[k - 1]))  # the states of (k-1)-grams
            self.fail_weight[own] = np.log10(mu / (counts[k - 2] + mu))
            if k > 2:
                any_ = np.zeros(sizes[k - 2], dtype=np.int64)
                any_[shorter] = np.arange(n)
                self.fail[own] = offset[k - 3] + grams.index[k - 3][any_]
        by = np.argsort(keys := np.concatenate(keys))
        self.keys, self.weight, self.target = keys[by], np.concatenate(weights)[by], np.concatenate(targets)[by]

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight, next state) of reading a word in each state: failure arcs until there is an arc."""
        weight, state, after = np.zeros(len(state)), state.copy(), np.empty(len(state), dtype=np.int32)
        open_ = np.arange(len(state))
        while len(open_):
            s = state[open_]
            root = s == ROOT
            at = open_[root]
            weight[at] += self.root_weight[word[at]]
            after[at] = self.root_target[word[at]]
            open_, s = open_[~root], s[~root]
            if not len(self.keys):
                weight[open_] += self.fail_weight[s]
                state[open_] = self.fail[s]
                continue
            key = s.astype(np.int64) * self.words + word[open_]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            has = self.keys[place] == key
            weight[open_[has]] += self.weight[place[has]]
            after[open_[has]] = self.target[place[has]]
            open_, s = open_[~has], s[~has]
            weight[open_] += self.fail_weight[s]
            state[open_] = self.fail[s]
        return weight, after

    def walk(self, lane: int = LANE) -> np.ndarray:
        """log10 probability of each token, from the left, the state carried along.

        All documents are read side by side, long ones in lanes of `lane` tokens: a state holds at most order - 1 words, so
        a lane that starts within a document is in its state after reading the order - 1 words before it.
        """
        g, word = self.grams, self.grams.index[0]
        n, warm = len(word), g.order - 1
        ends = np.append(g.start[1:], n)
        lanes = -(-(ends - g.start) // lane)
        doc = np.repeat(np.arange(len(lanes)), lanes)
        inner = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = g.start[doc] + inner * lane
        size = np.minimum(ends[doc], start + lane) - start
        by = np.argsort(-size, kind="stable")
        start, size, first = start[by], size[by], inner[by] == 0
        state = np.where(first & (g.order > 1), FIRST, ROOT).astype(np.int32)
        late = np.flatnonzero(~first)
        for back in range(warm, 0, -1):
            state[late] = self.step(state[late], word[start[late] - back])[1]
        out = np.empty(n)
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -t, side="left"))  # lanes of more than t tokens come first
            at = start[:live] + t
            out[at], state[:live] = self.step(state[:live], word[at])
        return out
