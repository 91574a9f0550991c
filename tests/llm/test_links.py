"""Operator 4 against all pairs by brute force, operator 10 against plain windows, edges of both."""

import itertools
import math
import random
import re

import numpy as np
import pytest

from ledgerloom.llm import op4_ngram_join, op10_decontaminate, shingles
from ledgerloom.llm.graph import components
from ledgerloom.llm.suffixes import suffix_array

from .helpers import WORDS, edge_documents, edge_texts, no_documents, prose, rows


def _sets(texts):
    for t in texts:
        w = (t or "").encode().lower().split()
        yield {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _classes(docs):
    sets, n = list(_sets(t for _, t in docs)), len(docs)
    up, links = list(range(n)), [0] * n
    root = lambda x: x if up[x] == x else root(up[x])
    for i, j in itertools.combinations(range(n), 2):
        if docs[i][0] is None or docs[j][0] is None or not sets[i] or not sets[j]:
            continue
        both = len(sets[i] & sets[j])
        if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
            links[i] += 1
            links[j] += 1
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    low = {}
    for i in range(n):
        if docs[i][0] is not None:
            low[root(i)] = min(low.get(root(i), docs[i][0]), docs[i][0])
    return sorted((d[0] if d[0] is not None else -1, low.get(root(i), -1), links[i]) for i, d in enumerate(docs))


def _near(count, seed):
    """Chains and clouds of near copies with one to many edits, and unrelated texts."""
    rnd, out = random.Random(seed), []
    for g in range(count):
        words = prose(rnd.randint(30, 120), 100 * seed + g).split()
        for _ in range(rnd.randint(1, 9)):
            out.append(" ".join(words))
            for _ in range(rnd.randint(0, 2)):
                words[rnd.randrange(len(words))] = rnd.choice(WORDS) + str(rnd.randint(0, 9))
    rnd.shuffle(out)
    return list(enumerate(out, 1000))


@pytest.mark.parametrize("block", [1024, 4])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(op4_ngram_join, "BLOCK", block)
    docs = edge_texts() + _near(25, 7)
    got = rows(op4_ngram_join.classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)))
    as_known = lambda x: -1 if x is None else x
    assert sorted((as_known(r["doc_id"]), as_known(r["class_id"]), r["n_links"]) for r in got) == _classes(docs)


def test_join_edges(spark):
    assert rows(op4_ngram_join.classes(no_documents(spark))) == []
    docs = edge_documents(spark)
    kept = op4_ngram_join.stage(spark, docs, "")
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] or 0 for r in rows(kept))
    assert 6 not in ids and 13 not in ids and {1, 2, 3, 4, 5, 7, 8} <= set(ids)


def test_stage_removes_rows_and_not_ids(spark):
    """Repeated ids with different texts, copies that share an id, copies without one."""
    a, b, c, d = (prose(60, 700 + k) for k in range(4))
    near = a.replace(a.split()[30], "changed", 1)
    docs = [(1, a), (2, near), (2, b), (3, c), (3, c), (None, c), (None, d), (None, d), (None, "")]
    got = rows(op4_ngram_join.stage(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(3), ""))
    known = lambda x: (x[0] or 99, x[1])
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=known) == sorted([(1, a), (2, b), (3, c), (None, d), (None, "")], key=known)


def test_least_matches_is_the_posterior():
    for k, m in enumerate(shingles.least_matches(0.8, 1e-3), 1):
        n, t = 16 * k, 0.8 + 0.2 / 256
        grid = np.linspace(0, 1, 200_001)

        def mass(m, n=n, t=t, grid=grid):
            logp = m * np.log(np.maximum(grid, 1e-300)) + (n - m) * np.log(np.maximum(1 - grid, 1e-300))
            p = np.exp(logp - logp.max())
            return p[grid >= t].sum() / p.sum()

        assert mass(m) >= 1e-3 * 0.98 and (m == 0 or mass(m - 1) < 1e-3 * 1.02)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    other = np.unique(np.concatenate([base[:3000], rng.integers(0, 1 << 63, 1000).astype(np.uint64)]))
    v = shingles.signatures([base, other])
    true = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
    assert abs((v[0] == v[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / shingles.HASHES)


def test_intersections():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 90, rng.integers(1, 60)).astype(np.uint64)) for _ in range(150)]
    got = shingles.intersections(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(150) for j in range(i + 1, 150))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["label"] for r in rows(components(spark.createDataFrame(edges, "u long, v long")))}
    assert all(got[i] == 0 for i in range(61)) and {got[i] for i in (100, 101, 102)} == {100} and 200 not in got


def test_suffix_array():
    rng = np.random.default_rng(8)
    for n in (0, 1, 50, 400):
        ids = rng.integers(0, 4, n)
        order = suffix_array(ids, 27)
        keys = [tuple(ids[i : i + 27]) for i in order]
        assert sorted(order.tolist()) == list(range(n)) and keys == sorted(keys)


FOLD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(t):
    return FOLD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def _hits(text, items, window=10):
    w, hit, names = _words(text), set(), set()
    for name, t in items:
        x = _words(t)
        if name is None or not x:
            continue
        k = min(window, len(x))
        grams = {tuple(x[i : i + k]) for i in range(len(x) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


def _longest(text, items):
    """Words, start and item of the longest run of words that a text and an item share, in plain loops."""
    w, best = _words(text), (0, -1, None)
    for name, t in sorted(((str(n), _words(t)) for n, t in items if n is not None), key=lambda x: x[0]):
        for i in range(len(w)):
            for j in range(len(t)):
                k = 0
                while i + k < len(w) and j + k < len(t) and w[i + k] == t[j + k]:
                    k += 1
                if k > best[0] or (k == best[0] > 0 and i < best[1]):
                    best = (k, i, name)
    return best


@pytest.mark.parametrize("block_bytes", [8_000_000, 400])
def test_matches_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(op10_decontaminate, "SHARD_WORDS", 3000)
    rnd = random.Random(9)
    items = [(i, prose(rnd.randint(3, 40), 500 + i)) for i in range(12)] + [(3, prose(30, 900)), (50, "One, Two; THREE"), (51, None), (52, "..."), (None, prose(20, 901))]
    docs = edge_texts() + [(100 + k, prose(15, k) + " " + rnd.choice(items)[1].__str__() + ", " + prose(rnd.randint(0, 15), k + 50) + rnd.choice(["", " one two three", " " + prose(40, 505)[20:]])) for k in range(40)]
    got = rows(op10_decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes))
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"]) for r in got) == sorted((i or 0, *_hits(t, items)) for i, t in docs)
    short = {i: t for i, t in docs if i and i != 8}
    assert {r["doc_id"]: (r["longest"], r["longest_start"], r["longest_item"]) for r in got if r["doc_id"] in short and r["doc_id"] != 6} == {i: _longest(t, items) for i, t in short.items() if i != 6}


def test_every_suffix_is_searched():
    """Matches of 1 to 9 words, at an item's last words too, and runs that many documents and items share."""
    rnd = random.Random(4)
    letters = [f"w{i}" for i in range(6)]
    items = [(f"i{k:02}", " ".join(rnd.choice(letters) for _ in range(rnd.randint(1, 14)))) for k in range(30)] + [("j1", " ".join(f"s{i}" for i in range(20)))] * 2 + [("j0", " ".join(f"s{i}" for i in range(3, 20)))]
    texts = [" ".join(rnd.choice([*letters, "q"]) for _ in range(rnd.randint(0, 30))) for _ in range(120)] + [f"z s{k} s{k + 1}" for k in range(19)] + ["z " + " ".join(f"s{i}" for i in range(2, 18))] * 3
    from ledgerloom.llm.suffixes import Shard, Tests

    shard = Shard(Tests(items, 10))
    for t in texts:
        shard.add(t)
    found = shard.search()
    assert [x[:3] for x in found] == [_hits(t, items) for t in texts]
    assert [x[3:6] for x in found] == [_longest(t, items) for t in texts]


def test_longest_match(spark):
    item = prose(40, 1)
    text = prose(7, 2) + " " + " ".join(item.split()[5:30]) + " end " + " ".join(item.split()[:12])
    r = rows(op10_decontaminate.matches(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(4, item)], "item_id long, text string")))[0]
    assert (r["longest"], r["longest_start"], r["longest_item"], r["n_hit"]) == (25, 7, "4", 37)


def test_decontamination_edges(spark):
    docs = edge_documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["n_hit"] == 0 for r in rows(op10_decontaminate.matches(docs, none)))
    assert op10_decontaminate.remove(docs, none).count() == docs.count()
    item = spark.createDataFrame([(1, prose(60, 1))], "item_id long, text string")
    left = op10_decontaminate.remove(docs, item)
    assert left.columns == docs.columns and sorted(r["doc_id"] or 0 for r in rows(left)) == [0, 2, 3, 4, 5, 7, 8, 9, 10, 12, 13]
    assert rows(op10_decontaminate.matches(no_documents(spark), item)) == []
