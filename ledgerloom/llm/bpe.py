"""BPE by speculation: greedy longest match proposes, pair checks verify, only failing words are merged exactly.

A sequence of tokens is what the merges give for a word if, and only if, each token is the merges' result for
its own characters and no merge crosses the border of two neighbours before both sides are complete. That makes
verification local: it needs pairs only, and all pairs of all new words of a batch are tested together in numpy.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers

WORD_END = "</w>"
VOCABULARY = "word_bpe_49k.json"
#: Words kept for each worker process; beyond that the memory starts anew.
KEPT_WORDS = 700_000
#: Bytes up to which words that fail are merged together, step by step; longer ones are merged one by one, in n log n.
SHORT = 64
#: Bytes from which a word is long: matched at all its places at once, and merged exactly only where its guess fails.
LONG = 512
#: Places of a long word that are matched together.
PLACES = 1 << 20
_NEVER = np.int64(1) << 60

# Characters whose case, composition and class agree in every library: the others take the library's own splitter.
_LETTERS = "a-zªµºß-öø-ÿā-įı-ňŋ-ſ"
_DIGITS = "0-9²³¹¼-¾"
_SAFE = re.compile("[^\t\n\r\\x20-~¡-ÿĀ-įı-ňŊ-ſ‐-‧‰-⁞€]")
_FAST = re.compile(f"[{_LETTERS}]+|[{_DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^\\s{_LETTERS}{_DIGITS}]+")


def _byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself if visible in Latin-1, else the next code point from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    names = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class IntMap:
    """Whole numbers to whole numbers for arrays of keys: open addressing in two arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        open_, at = np.arange(len(keys)), self._home(keys)
        while open_.size:
            free = open_[self.keys[at[open_]] < 0]
            self.keys[at[free]] = keys[free]
            won = self.keys[at[open_]] == keys[open_]
            self.values[at[open_[won]]] = values[open_[won]]
            open_ = open_[~won]
            at[open_] = (at[open_] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        out, at, open_ = np.full(len(keys), default, dtype=np.int64), self._home(keys), np.arange(len(keys))
        while open_.size:
            there = self.keys[at]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            go = ~hit & (there >= 0)
            open_, at = open_[go], (at[go] + 1) & self.mask
        return out


class SpeculativeBPE:
    """The vocabulary's merges as arrays, and a memory of encoded words."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.size = size
        self.rank = np.full(size, -1, dtype=np.int64)
        self.rank[made] = np.arange(len(made))
        self.left, self.right = np.arange(size), np.arange(size)
        self.left[made], self.right[made] = left, right
        self.made, self.made_row = made.tolist(), made
        self.rank_of_pair = {k: r for r, k in enumerate((left * size + right).tolist())}
        self.pair_rank = IntMap(left * size + right, np.arange(len(made)))
        self.alphabet = _byte_alphabet()
        self._begin()
        self.valid = self._valid(made, left, right)
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        library = Tokenizer.from_file(path)
        self._normalise, self._split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.exact = self.guessed = 0

    def _begin(self) -> None:
        """The tokens as a tree of bytes, 256 for a word's end: children by node and byte, and the token each node is."""
        byte = {c: b for b, c in enumerate(self.alphabet)}
        children: dict[int, int] = {}
        token = [-1]
        for t, i in self.vocab.items():
            inner, node = t.removesuffix(WORD_END), 0
            for b in [byte[c] for c in inner] + [256] * (inner != t):
                node = children.setdefault(node * 257 + b, len(token))
                if node == len(token):
                    token.append(-1)
            token[node] = i
        self.width = np.zeros(self.size, dtype=np.int64)
        for t, i in self.vocab.items():
            self.width[i] = len(t.removesuffix(WORD_END))
        self.child = IntMap(np.array(list(children), dtype=np.int64), np.array(list(children.values()), dtype=np.int64))
        self.token_at = np.array(token, dtype=np.int64)
        self.first = np.array([self.vocab[c] for c in self.alphabet], dtype=np.int64)
        self.last = np.array([self.vocab[c + WORD_END] for c in self.alphabet], dtype=np.int64)
        self.byte_of = byte

    def _valid(self, made, left, right) -> np.ndarray:
        """Whether the merges give each token for its own characters, so that it may stand in a result."""
        out = np.ones(self.size, dtype=bool)
        ok = self.compatible(left, right, self.rank[made])
        for r in np.argsort(self.rank[made]):
            out[made[r]] = ok[r] and out[left[r]] and out[right[r]]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair of tokens, whether no merge crosses their border.

        The merges of both sides are undone from the latest to the earliest. Whenever the two tokens that then
        touch could merge earlier than what was just undone, the pair can't stand. Of equal merges the left one
        comes first, so an undone left merge wins a tie and an undone right one loses it.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), _NEVER) if limit is None else limit.astype(np.int64)
        ok, live = np.ones(len(a), dtype=bool), np.arange(len(a))
        while live.size:
            bad = self.pair_rank.get(a[live] * self.size + b[live], _NEVER) < limit[live]
            ok[live[bad]] = False
            live = live[~bad]
            ra, rb = self.rank[a[live]], self.rank[b[live]]
            more = (ra >= 0) | (rb >= 0)
            live, ra, rb = live[more], ra[more], rb[more]
            of_a = ra > rb
            limit[live] = np.where(of_a, ra, rb + 1)
            a[live[of_a]] = self.right[a[live[of_a]]]
            b[live[~of_a]] = self.left[b[live[~of_a]]]
        return ok

    def greedy(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest matches from the left, the last with the word's end, of all words of `data` together.

        Each step follows one byte of every open word; where no token goes on, the longest one so far is taken and the
        word goes on behind it. Gives tokens, the word of each, and which words have a place without a match.
        """
        n = len(starts)
        at, node, best, behind = starts.copy(), np.zeros(n, np.int64), np.full(n, -1), starts.copy()
        open_, failed, tokens, words = np.arange(n), np.zeros(n, bool), [], []
        while open_.size:
            inside = at[open_] < ends[open_]
            byte = np.where(inside, data[np.minimum(at[open_], len(data) - 1)], 256)
            child = self.child.get(node[open_] * 257 + byte, -1)
            on = child >= 0
            going, child = open_[on], child[on]
            node[going] = child
            at[going] += 1
            whole = self.token_at[child]
            done = ~inside[on]
            tokens.append(whole[done])
            words.append(going[done])
            longer = ~done & (whole >= 0) & (at[going] < ends[going])
            best[going[longer]], behind[going[longer]] = whole[longer], at[going[longer]]
            stuck = open_[~on]
            none = best[stuck] < 0
            failed[stuck[none]] = True
            stuck = stuck[~none]
            tokens.append(best[stuck])
            words.append(stuck)
            at[stuck], node[stuck], best[stuck] = behind[stuck], 0, -1
            open_ = np.concatenate([going[~done], stuck])
        tokens, words = np.concatenate(tokens), np.concatenate(words)
        order = np.argsort(words, kind="stable")
        return tokens[order], words[order], failed

    def _longest(self, data: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place of a word from low to high the longest token that starts there, -1 if none does, and the place behind it."""
        n = len(data)
        best, behind = np.full(high - low, -1), np.arange(low, high)
        open_, at, node = np.arange(high - low), np.arange(low, high), np.zeros(high - low, np.int64)
        while open_.size:
            inside = at < n
            child = self.child.get(node * 257 + np.where(inside, data[np.minimum(at, n - 1)], 256), -1)
            on = child >= 0
            open_, inside, node, at = open_[on], inside[on], child[on], at[on] + 1
            whole = self.token_at[node]
            longer = (whole >= 0) & ((at < n) | ~inside)
            best[open_[longer]], behind[open_[longer]] = whole[longer], np.minimum(at[longer], n)
            open_, at, node = open_[inside], at[inside], node[inside]
        return best, behind

    def long_word(self, word: bytes) -> list[int]:
        """Ids of one long word: guessed from the longest match at each place, and merged anew around each pair that can't stand.

        What is merged anew is exact within, so only its borders are tested again. Stretches grow with each round; a word that
        still fails when they are large is merged as a whole. Time grows with the word's length, not with its square.
        """
        data = np.frombuffer(word, np.uint8).astype(np.int64)
        ids, starts, at = [], [], 0
        for low in range(0, len(data), PLACES):
            high = min(len(data), low + PLACES)
            best, behind = (x.tolist() for x in self._longest(data, low, high))
            while at < high:
                if best[at - low] < 0:
                    return self.merge(word)
                ids.append(best[at - low])
                starts.append(at)
                at = behind[at - low]
        ids, starts = np.array(ids), np.array(starts)
        unsure, wrong = np.ones(len(ids) - 1, dtype=bool), ~self.valid[ids]
        for turn in range(8):
            pairs = np.flatnonzero(unsure)
            pairs = pairs[~self.compatible(ids[pairs], ids[pairs + 1])]
            at = np.concatenate([pairs, np.flatnonzero(wrong)])
            if not at.size:
                return ids.tolist()
            reach, most = 2 << turn, 32 << turn
            edge = np.zeros(len(ids) + 1, dtype=np.int64)
            np.add.at(edge, np.maximum(at - reach + 1, 0), 1)
            np.add.at(edge, np.minimum(at + reach + 1, len(ids)), -1)
            inner = np.cumsum(edge[:-1]) > 0
            # stretches of what is to be merged, the long ones cut into pieces
            begin = np.flatnonzero(inner & ~np.append(False, inner[:-1]))
            run = np.flatnonzero(inner & ~np.append(inner[1:], False)) + 1 - begin
            pieces = -(-run // most)
            first = np.repeat(begin, pieces) + most * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            last = np.minimum(first + most, np.repeat(begin + run, pieces))
            ids, starts, unsure = self._merged_anew(data, ids, starts, first, last)
            wrong = np.zeros(len(ids), dtype=bool)
        return self.merge(word)

    def _merged_anew(self, data: np.ndarray, ids: np.ndarray, starts: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens with stretches of them (first to last) merged exactly, their places, and which pairs lie across a stretch's border."""
        ends = np.append(starts, len(data))
        low, high = starts[first], ends[last]
        size = high - low
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        symbols = self.first[data[place]]
        if len(place) and place[-1] == len(data) - 1:
            symbols[-1] = self.last[data[-1]]
        tokens, own = self.merge_all(symbols, size)
        kept = np.ones(len(ids), dtype=bool)
        for a, b in zip(first.tolist(), last.tolist()):
            kept[a:b] = False
        width = self.width[tokens]
        count = np.bincount(own, minlength=len(first))
        begins = np.cumsum(count) - count
        within = np.cumsum(width) - width
        new_starts = within - np.repeat(within[begins], count) + np.repeat(low, count)
        all_starts = np.concatenate([starts[kept], new_starts])
        order = np.argsort(all_starts, kind="stable")
        out, at = np.concatenate([ids[kept], tokens])[order], all_starts[order]
        border = np.isin(at, np.concatenate([low, high]))
        return out, at, border[1:]

    def merge_all(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merges themselves for all words together, one merge of each word at a time: tokens and the word of each."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        out_tokens, out_words = [], []
        rank = self._ranks(symbols, word, np.arange(len(word)))
        while len(word):
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(start, len(word)))
            best = np.minimum.reduceat(rank, start)
            over = np.repeat(best == _NEVER, size)
            out_tokens.append(symbols[over])
            out_words.append(word[over])
            is_best = np.flatnonzero((rank == np.repeat(best, size)) & ~over)
            own = word[is_best]
            at = is_best[np.append(True, own[1:] != own[:-1])] if len(is_best) else is_best
            symbols[at] = self.made_row[rank[at]]
            gone = over
            gone[at + 1] = True
            kept = np.flatnonzero(~gone)
            place = np.cumsum(~gone) - 1
            at = place[at]
            symbols, word, rank = symbols[kept], word[kept], rank[kept]
            again = np.concatenate([at, at[at > 0] - 1])
            rank[again] = self._ranks(symbols, word, again)
        tokens, words = np.concatenate(out_tokens), np.concatenate(out_words)
        order = np.argsort(words, kind="stable")
        return tokens[order], words[order]

    def _ranks(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the merges of the symbols at these places with their right neighbours; of a word's last one, never."""
        right = np.minimum(at + 1, len(symbols) - 1)
        same = (word[right] == word[at]) & (at + 1 < len(symbols))
        found = self.pair_rank.get(symbols[at] * self.size + symbols[right], _NEVER)
        return np.where(same, found, _NEVER)

    def merge(self, word: bytes) -> list[int]:
        """The merges for one long word, by rank and then from the left, in n log n."""
        ids = self.first[list(word)].tolist()
        ids[-1] = int(self.last[word[-1]])
        rank = lambda x, y: self.rank_of_pair.get(x * self.size + y)
        before, after = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), -1]
        heap = [(r, i, x, y) for i, (x, y) in enumerate(zip(ids, ids[1:])) if (r := rank(x, y)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            if ids[i] != x or j < 0 or ids[j] != y:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank(ids[i], ids[k])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := rank(ids[h], ids[i])) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words (not empty, as the splitter gives them)."""
        coded = [w.encode() for w in words]
        out: list[list[int]] = [[]] * len(words)
        self.guessed += len(words)
        if not words:
            return out
        if max(map(len, coded)) > LONG:
            long = [i for i, w in enumerate(coded) if len(w) > LONG]
            rest = [i for i, w in enumerate(coded) if len(w) <= LONG]
            for i in long:
                out[i] = self.long_word(coded[i])
            for i, ids in zip(rest, self.encode_words([words[i] for i in rest])):
                out[i] = ids
            self.guessed -= len(rest)
            return out
        size = np.array([len(w) for w in coded])
        data, start = np.frombuffer(b"".join(coded), np.uint8).astype(np.int64), np.cumsum(size) - size
        tokens, word, failed = self.greedy(data, start, start + size)
        failed[word[~self.valid[tokens]]] = True
        inside = np.flatnonzero(word[1:] == word[:-1])
        fits = self.compatible(tokens[inside], tokens[inside + 1])
        failed[word[inside[~fits]]] = True
        good = ~failed[word]
        tokens, word = tokens[good], word[good]
        if failed.any():
            self.exact += int(failed.sum())
            for i in np.flatnonzero(failed & (size > SHORT)).tolist():  # of at most LONG bytes
                out[i] = self.merge(coded[i])
            bad = np.flatnonzero(failed & (size <= SHORT))
            of = np.repeat(bad, size[bad])
            place = np.arange(len(of)) - np.repeat(np.cumsum(size[bad]) - size[bad], size[bad]) + start[of]
            symbols = self.first[data[place]]
            end = place == (start + size - 1)[of]
            symbols[end] = self.last[data[place[end]]]
            more, own = self.merge_all(symbols, size[bad]) if len(bad) else (tokens[:0], word[:0])
            tokens, word = np.concatenate([tokens, more]), np.concatenate([word, bad[own]])
            order = np.argsort(word, kind="stable")
            tokens, word = tokens[order], word[order]
        cut, flat = np.searchsorted(word, np.arange(len(words) + 1)).tolist(), tokens.tolist()
        return [own or flat[a:b] for own, a, b in zip(out, cut, cut[1:])]

    def words(self, text: str) -> list[str]:
        """The text's words as the library splits them; special tokens stand for themselves."""
        if self.special_re is not None and "<|" in text and self.special_re.search(text):
            out, at = [], 0
            for m in self.special_re.finditer(text):
                out += self._plain(text[at : m.start()])
                out.append(m[0])
                at = m.end()
            return out + self._plain(text[at:])
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not _SAFE.search(text):
            return _FAST.findall(text.lower())
        back = self.byte_of
        return [bytes([back[c] for c in w]).decode() for w, _ in self._split(self._normalise(text))]

    def learn(self, words: set[str]) -> dict[str, list[int]]:
        """The ids of each word."""
        plain = [w for w in words if w not in self.special]
        new = dict(zip(plain, self.encode_words(plain))) if plain else {}
        new |= {w: [self.special[w]] for w in words if w in self.special}
        return new

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; a null text has none."""
        split = [self.words(t or "") for t in texts]
        ids = self.learn(set().union(*split)) if split else {}
        return [[i for w in words for i in ids[w]] for words in split]

    def decode(self, ids) -> str:
        """As the library decodes for a vocabulary without a decoder: the tokens with spaces between."""
        return " ".join([self.tokens[i] for i in ids])


class WordForms:
    """What each word's ids turn into, kept by word."""

    def __init__(self, bpe: SpeculativeBPE, make) -> None:
        self.bpe, self.make = bpe, make
        self.kept: dict[str, bytes] = {}

    def coded(self, texts: list[str | None]) -> list[list[bytes]]:
        """The forms of each text's words in order. Each word is looked up once; those not known are learned together."""
        get = self.kept.get
        split = [self.bpe.words(t or "") for t in texts]
        found = [list(map(get, words)) for words in split]
        new: set[str] = set()
        for words, forms in zip(split, found):
            new.update([w for w, f in zip(words, forms) if f is None])
        if new:
            if len(self.kept) + len(new) > KEPT_WORDS:
                self.kept.clear()
            make = self.make
            self.kept.update((w, make(i)) for w, i in self.bpe.learn(new).items())
            kept = self.kept
            found = [[kept[w] if f is None else f for w, f in zip(words, forms)] for words, forms in zip(split, found)]
        return found


@lru_cache(maxsize=2)
def load(path: str | None = None) -> SpeculativeBPE:
    """One for each worker process; by default the vocabulary of words, wherever its package is installed."""
    return SpeculativeBPE(path or public_tokenizers.path(VOCABULARY))
