"""Operators 2, 3 and 6: held-out accuracy, statistics against plain Python, edges."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chain, common, op2_quality, op3_rules, op6_toxicity
from ledgerloom.llm.attention import GatedAttention

from .helpers import edge_documents, edge_texts, no_documents, prose, rows

SF = "/root/testdata/sf0.1"


def test_attention_gradients():
    rng = np.random.default_rng(0)
    x, n, y = rng.normal(size=(9, 4)), np.array([2, 3, 1, 3]), np.array([1.0, 0, 1, 0])
    m = GatedAttention.fit(x, n, y, hidden=3, gate=2, epochs=1)
    loss = lambda: -(y * np.log(p := m._forward(x, n)[-1]) + (1 - y) * np.log(1 - p)).mean()
    for k, g in m._grads(x, n, y).items():
        at = tuple(0 for _ in g.shape)
        keep = m.p[k][at]
        m.p[k][at] = keep + 1e-5
        up = loss()
        m.p[k][at] = keep - 1e-5
        down = loss()
        m.p[k][at] = keep
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_quality_held_out(spark):
    docs, labels = common.table(spark, SF, "documents").where("doc_id < 5000"), common.table(spark, SF, "labels")
    model = op2_quality.fit(docs, labels, most=800)
    got = op2_quality.scores(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert ((got.predicted == 1) == (got.quality == 1)).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_quality_edges(spark):
    docs = edge_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 1), (7, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = op2_quality.fit(docs, labels)
    got = rows(op2_quality.scores(docs, model))
    assert len(got) == len(edge_texts()) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in rows(op2_quality.scores(docs, None))} == {0.5}
    assert op2_quality.fit(docs, labels.limit(0)) is None
    assert rows(op2_quality.scores(no_documents(spark), model)) == []
    kept = op2_quality.keep(docs, model, cut=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def _plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    c, hit = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if c[tuple(w[i : i + 8])] > 1:
            hit |= set(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_statistics(spark):
    more = [(20, "x " * 40), (21, prose(12, 5) + " " + prose(12, 5)), (22, "a b\n\na b\n a b\r\na b"), (23, prose(9, 6) + " q " + prose(9, 6) + " r " + prose(30, 7) + " " + prose(9, 6)), (24, "$$ 😀* |<>&%#")]
    docs = edge_documents(spark).select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted(tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in rows(op3_rules.statistics(docs)))
    assert got == sorted(_plain(t) for _, t in edge_texts() + more)
    assert rows(op3_rules.statistics(no_documents(spark))) == []


def test_rules(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    rules = op3_rules.fit(docs, labels)
    assert 1 <= len(rules) <= 8
    out = op3_rules.verdicts(docs, rules)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = out.withColumn("held_out", op3_rules.labelled.held_out()).join(labels, "doc_id").where("held_out").toPandas()
    bad = ~got.kept & ~got.base_failed
    assert (got.quality[bad] == 0).mean() > 0.95
    assert (got.kept == (got.quality == 1))[~got.base_failed].mean() > 0.95
    assert op3_rules.learn([], []) == [] and op3_rules.learn([{m: 0.0 for m in op3_rules.MEASURES}] * 5, [True] * 5) == []


def test_rules_without_labels_keep_what_the_base_keeps(spark):
    got = rows(op3_rules.verdicts(edge_documents(spark), []))
    assert all(r["kept"] == (not r["base_failed"]) and r["rule"] is None for r in got) and len(got) == len(edge_texts())


def test_toxicity(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    model = op6_toxicity.fit(docs, labels)
    got = op6_toxicity.scores(docs, model).join(labels.select("doc_id", F.col("toxic").alias("label")), "doc_id").where("held_out").toPandas()
    assert (got.toxic == got.label).mean() > 0.98 and (got.toxic[got.label == 1] == 1).mean() > 0.9 and (got.toxic[got.label == 0] == 0).mean() > 0.985
    assert got.p_varied[got.label == 0].mean() < 0.1


def test_toxicity_edges(spark):
    docs = edge_documents(spark)
    labels = spark.createDataFrame([(1, 0), (7, 1), (9, 0)], "doc_id long, toxic int")
    model = op6_toxicity.fit(docs, labels)
    assert len(rows(op6_toxicity.scores(docs, model))) == len(edge_texts())
    assert op6_toxicity.fit(docs, labels.limit(0)) is None
    assert all(r["p_toxic"] == 0 for r in rows(op6_toxicity.scores(docs, None)))
    assert rows(op6_toxicity.scores(no_documents(spark), model)) == []


def test_chain_feeds_out_of_fold_probabilities():
    """Each link's probabilities equal those of plain loops; what a document is fed comes from models that didn't see it."""
    rng = np.random.default_rng(2)
    docs = [np.unique(rng.integers(0, 30, 8)) for _ in range(300)]
    has = lambda w: np.array([float(w in d) for d in docs])
    toxic = np.maximum(has(1), has(2))
    y = np.column_stack([toxic * has(3), toxic])
    bags, folds = chain.Bags(docs), np.arange(300) % 3
    links, held_out = chain.fit(bags, 30, y, folds)
    assert links[1].earlier.shape == (1,) and links[1].earlier[0] > 0
    sigmoid = lambda x: 1 / (1 + math.exp(-max(-30, min(30, x))))
    for d, p in list(zip(docs, chain.predict(links, bags)))[:40]:
        first = sigmoid(links[0].bias + sum(links[0].weights[w] for w in d))
        last = sigmoid(links[1].bias + sum(links[1].weights[w] for w in d) + links[1].earlier[0] * first)
        assert abs(p[0] - first) < 1e-12 and abs(p[1] - last) < 1e-12
    assert ((chain.predict(links, bags) > 0.5) == (y > 0.5)).mean() > 0.97
    own = folds == 1
    others = y.copy()
    others[own] = 1 - others[own]  # labels of a fold don't change what its own documents are fed
    assert np.array_equal(chain.fit(bags, 30, others, folds)[1][own, 0], held_out[own, 0])


def test_finer_labels_do_not_see_their_own_fold():
    rng = np.random.default_rng(3)
    docs = [np.unique(rng.integers(0, 40, 12)) for _ in range(240)]
    toxic = np.array([float(bool({1, 2, 3} & set(d.tolist()))) for d in docs])
    features, sizes, folds = [b"w%d" % i for i in range(40)], np.full(240, 12), np.arange(240) % 3
    y = op6_toxicity._finer(chain.Bags(docs), features, sizes, toxic, folds)
    assert (y[:, 2] == toxic).all() and (y[:, 0] <= toxic).all() and 0 < y[:, 1].sum() <= toxic.sum()
    other = toxic.copy()
    other[folds == 0] = 1.0
    again = op6_toxicity._finer(chain.Bags(docs), features, sizes, other, folds)
    was = (folds == 0) & (toxic > 0)
    assert (again[was, :2] == y[was, :2]).all()


def test_best_cut():
    assert chain.best_cut(np.array([0.9, 0.8, 0.3, 0.1]), np.array([1.0, 1, 0, 0])) == pytest.approx(0.55)
    assert chain.best_cut(np.array([0.9, 0.8]), np.array([1.0, 1])) == 0.5
    rng = np.random.default_rng(1)
    p, y = rng.random(50).round(1), (rng.random(50) < 0.4).astype(float)
    f1 = lambda c: 2 * (y * (p >= c)).sum() / ((p >= c).sum() + y.sum())
    assert f1(chain.best_cut(p, y)) == pytest.approx(max(f1(c) for c in p))
