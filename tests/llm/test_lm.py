"""Operator 9 against plain counts, and that the automaton is a distribution."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import backoff, op9_lm_score

from .helpers import edge_documents, edge_texts, no_documents, prose, rows


def _plain(docs, train, order, mu):
    grams, tokens = Counter(), []
    for (_, t), use in zip(docs, train):
        w = [b"  "] + (t or "").encode().lower().split() + [b" "]
        tokens.append(w)
        if use:
            for k in range(1, order + 1):
                grams.update(tuple(w[i - k + 1 : i + 1]) for i in range(1, len(w)) if i - k + 1 >= 0)
    n, v = sum(c for g, c in grams.items() if len(g) == 1), sum(len(g) == 1 for g in grams)
    count = lambda g: sum(train) if g == (b"  ",) else grams[g]

    def p(g):
        if len(g) == 1:
            return (grams[g] + 1) / (n + v + 1)
        return (grams[g] + mu * p(g[1:])) / (count(g[:-1]) + mu)

    out = []
    for (i, _), w, use in zip(docs, tokens, train):
        at = range(1, len(w))
        base = sum(math.log10((grams[(w[j],)] + 1) / (n + v + 1)) for j in at)
        score = sum(math.log10(p(tuple(w[max(0, j - order + 1) : j + 1]))) for j in at)
        out.append((i or 0, not use, len(w) - 1, sum(grams[(w[j],)] > 0 for j in at), n, round(base, 6), round(score, 6)))
    return sorted(out)


@pytest.mark.parametrize(("order", "block", "fan"), [(2, 1_200_000, 256), (3, 150, 256), (3, 3000, 3), (4, 1000, 256), (1, 100, 256)])
def test_scores_equal_plain_counts(spark, order, block, fan):
    docs = edge_texts() + [(100 + k, prose(25, k % 7)) for k in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = rows(op9_lm_score.scores(frame, held_out=F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False)), order=order, mu=3.0, block_tokens=block, range_grams=10_000, fan=fan))
    train = [i is None or i % 3 != 1 for i, _ in docs]
    names = ("held_out", "n_tokens", "n_known", "train_tokens")
    assert sorted((r["doc_id"] or 0, *(r[c] for c in names), round(r["base_score"], 6), round(r["score"], 6)) for r in got) == _plain(docs, train, order, 3.0)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = rows(op9_lm_score.scores(docs, held_out=F.lit(True)))
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in got)
    assert rows(op9_lm_score.scores(no_documents(spark))) == []
    assert len(rows(op9_lm_score.scores(edge_documents(spark)))) == len(edge_texts())


def test_arcs_of_a_state_are_a_distribution():
    text = [b"a", b"b", b"a", b"c", b"a", b"b"]
    vocabulary = [backoff.END, b"a", b"b", b"c", b"unknown"]
    hashes = np.array([backoff.word_hash(w) for w in vocabulary], dtype=np.uint64)
    number = {w: i for i, w in enumerate(vocabulary)}
    train = [number[w] for w in text] + [0]
    # one document to learn from, then `a x` for every word x
    tests = [[number[b"a"], i] for i in range(1, 5)] + [[number[b"a"], 0]]
    tokens = np.array(train + [t for x in tests for t in x])
    sizes = np.array([len(train)] + [2] * len(tests))
    for order in (2, 3):
        g = backoff.Grams(tokens, sizes, hashes, order)
        counts = g.counted(np.repeat(np.array([True] + [False] * len(tests)), sizes))
        walk = backoff.Automaton(g, counts, 1, len(train), 4, 2.0).walk()
        after_a = walk[len(train) + 1 :: 2]
        assert math.isclose(sum(10**x for x in after_a), 1.0, rel_tol=1e-12)


def test_failure_arcs_are_walked_and_lanes_do_not_matter():
    """After an unknown pair the state falls to the root; reading in lanes gives what one reading from the left gives."""
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 40, 60)
    tokens = rng.integers(1, 9, sizes.sum())
    tokens[np.cumsum(sizes) - 1] = 0
    hashes = np.array([backoff.word_hash(b"%d" % i) for i in range(9)], dtype=np.uint64)
    g = backoff.Grams(tokens, sizes, hashes, 4)
    automaton = backoff.Automaton(g, g.counted(np.repeat(np.arange(60) < 20, sizes)), 20, 400, 9, 1.5)
    depth = np.zeros(len(automaton.fail), dtype=int)
    for s in range(len(depth)):
        at = s
        while at != backoff.ROOT:
            at, depth[s] = automaton.fail[at], depth[s] + 1
    assert depth.max() == 3 and depth[backoff.FIRST] == 1
    assert np.allclose(automaton.walk(4), automaton.walk(1000))


def test_numbers_come_back():
    from ledgerloom.llm import op9_lm_score as op

    x = np.array([0, 1, 255, 256, 1 << 40, (1 << 64) - 1], dtype=np.uint64)
    assert (op.unpacked(op.packed(x)) == x).all() and (op.unpacked_hashes(op.packed_hashes(x)) == x).all()
    y = x >> np.uint64(20) << np.uint64(20)
    assert (op.unpacked_hashes(op.packed_hashes(y, 20), 20) == y).all() and op._cut_bits(3, 1 << 20) == [0, 18, 18] and op._cut_bits(3, 10**13) == [0, 0, 0]
    assert len(op.unpacked(op.packed(x[:0]))) == 0 and (op.unpacked(op.packed(np.arange(5), "<u4"), "<u4") == np.arange(5)).all()


def test_held_out_text_is_likelier_than_under_unigrams(spark):
    docs = [(k, "amber river stone then velvet harbor gate. " * 3 + prose(10, k)) for k in range(40)]
    got = rows(op9_lm_score.scores(spark.createDataFrame(docs, "doc_id long, text string")))
    held = [r for r in got if r["held_out"]]
    assert held and all(r["score"] > r["base_score"] for r in held)
