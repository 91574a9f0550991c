"""Operator 6: toxicity categories of whole documents by a classifier chain.

The labels know one category. From it and the words that tell it, two finer ones are drawn for the labelled sample:
`varied` documents are toxic and have several such words, `dense` ones are toxic and such words make up a large share.
What tells is learned for each fold from the others. The chain predicts varied, then dense, then toxic, each model fed
with the earlier probabilities; in the fit those come from models of other folds, and so does the cut of `toxic`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chain, common, labelled
from .suffixes import words

#: Labelled documents that the chain is fitted on, at most, and folds for the probabilities that later models learn from.
MOST_LABELLED, FOLDS = 6000, 3
CATEGORIES = ("varied", "dense", "toxic")
#: Telling words that a varied document has, and the weight from which a word tells.
VARIED, TELLS = 3, 1.0


def _bag(text: str | None) -> frozenset[bytes]:
    """The text's words, and their beginnings of four and five bytes: stems tell where endings vary."""
    own = set(words(text))
    for k in (4, 5):
        own |= {b"^" + w[:k] for w in own if len(w) > k and w[:1] != b"^"}
    return frozenset(own)


@dataclass
class Model:
    """The chain over numbered features, and the probability from which a document is toxic."""

    features: list[bytes]
    links: list[chain.Linear]
    cut: float

    def predict(self, bags: list[frozenset[bytes]]) -> np.ndarray:
        number = {w: i for i, w in enumerate(self.features)}
        known = number.keys()
        return chain.predict(self.links, chain.Bags([np.array(sorted(number[w] for w in known & b), dtype=np.int64) for b in bags]))


def _finer(bags: chain.Bags, features: list[bytes], sizes: np.ndarray, toxic: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """varied, dense and toxic; what tells, and which share of a document is much, comes from the other folds."""
    word = np.array([not w.startswith(b"^") for w in features], dtype=bool)
    out = np.column_stack([np.zeros(len(toxic)), np.zeros(len(toxic)), toxic])
    for rest, own in chain.splits(folds):
        first = chain.Linear.fit(bags.only(rest), len(features), np.zeros((len(rest), 0)), toxic[rest])
        n = bags.sums(((first.weights > TELLS) & word).astype(float))
        share = n / np.maximum(1, sizes)
        of_toxic = share[rest][(toxic[rest] > 0) & (n[rest] > 0)]
        middle = np.median(of_toxic) if len(of_toxic) else 1.0
        out[own, 0] = toxic[own] * (n[own] >= VARIED)
        out[own, 1] = toxic[own] * (share[own] >= middle) * (n[own] > 0)
    return out


def _vocabulary(bags: DataFrame) -> list[bytes]:
    """Features that tell most in the whole sample and in each set of all folds but one: FOLDS + 1 times MOST_FEATURES at most."""
    y, folds = F.col("y"), range(FOLDS)
    in_fold = lambda f: F.col("fold") == f
    sums = [F.count("*").alias("n"), F.sum(y).alias("y"), *[F.count_if(in_fold(f)).alias(f"n{f}") for f in folds], *[F.sum(F.when(in_fold(f), y).otherwise(0.0)).alias(f"y{f}") for f in folds]]
    docs = bags.agg(*sums).first()
    counts = bags.select("y", "fold", F.explode("features").alias("w")).groupBy("w").agg(*sums).where(F.col("n") >= chain.LEAST_DOCS)
    counts = common.persist(counts, "toxic-counts")

    def top(n, pos, n_docs: float, positive: float) -> DataFrame:
        gap = F.abs((pos + 0.5) / (positive + 1) - (n - pos + 0.5) / (n_docs - positive + 1)) / F.sqrt((n + 1) / max(1, n_docs))
        return counts.where(n >= chain.LEAST_DOCS).orderBy(gap.desc(), "w").limit(chain.MOST_FEATURES).select("w")

    out = top(F.col("n"), F.col("y"), docs["n"], docs["y"])
    for f in folds:
        out = out.union(top(F.col("n") - F.col(f"n{f}"), F.col("y") - F.col(f"y{f}"), docs["n"] - docs[f"n{f}"], docs["y"] - docs[f"y{f}"]))
    return sorted(bytes(r[0]) for r in out.distinct().collect())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST_LABELLED) -> Model | None:
    """The chain, from at most `most` labelled documents that aren't held out; None without any.

    The features are chosen in Spark; the driver gets their numbers in each sampled document, 24 kB for one at most, and
    fits in numpy. A document's fold is by a hash of its id.
    """
    common.prepare(docs.sparkSession)

    def bags(batches):
        from ledgerloom.llm import op6_toxicity as own

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sets = [sorted(own._bag(t)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.binary())), part.column(2)], ["id", "features", "y"])

    rows = labelled.sample(docs, labels, [label_col], most, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    sampled = rows.select(id_col, text_col, F.col(f"label_{label_col}").cast("double").alias("y")).mapInArrow(bags, f"id {kind}, features array<binary>, y double")
    sampled = common.persist(sampled.withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int")), "toxic-bags")
    if sampled.isEmpty():
        return None
    features = _vocabulary(sampled)

    def numbered(batches):
        number = {w: i for i, w in enumerate(features)}
        for batch in batches:
            sets = batch.column(1).to_pylist()
            numbers = [np.array([number[w] for w in s if w in number], dtype="<i2").tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), *batch.columns[2:]], ["id", "numbers", "size", "y", "fold"])

    got = sampled.select("id", "features", "y", "fold").mapInArrow(numbered, f"id {kind}, numbers binary, size long, y double, fold int").toPandas().sort_values(["id", "numbers"], kind="stable")
    own, folds = chain.Bags([np.frombuffer(x, "<i2") for x in got["numbers"]]), got["fold"].to_numpy()
    y = _finer(own, features, got["size"].to_numpy(), got["y"].to_numpy(), folds)
    links, held_out = chain.fit(own, len(features), y, folds)
    used = np.flatnonzero(sum(np.abs(m.weights) for m in links) > 0)
    links = [chain.Linear(m.bias, m.weights[used], m.earlier) for m in links]
    return Model([features[i] for i in used], links, chain.best_cut(held_out[:, -1], y[:, -1]))


def scores(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", cut: float | None = None) -> DataFrame:
    """(id, held_out, p_varied, p_dense, p_toxic, toxic) of every document row.

    toxic: whether p_toxic, the chain's last probability, is the cut at least, by default the model's own. All words of a
    text count; null and empty texts have none and get what the biases say. Without a model the probabilities are 0 and
    nothing is toxic. Other columns are not read.
    """
    common.prepare(docs.sparkSession)
    cut = cut if cut is not None else model.cut if model else 0.5

    def run(batches):
        from ledgerloom.llm import op6_toxicity as own

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                bags = [own._bag(t) for t in part.column(1).to_pylist()]
                p = model.predict(bags) if model else np.zeros((len(bags), len(CATEGORIES)))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(p[:, k]) for k in range(len(CATEGORIES))]], [id_col, *[f"p_{c}" for c in CATEGORIES]])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"p_{c} double" for c in CATEGORIES))
    return out.select(id_col, labelled.held_out(id_col).alias("held_out"), *[f"p_{c}" for c in CATEGORIES], (F.col("p_toxic") >= cut).cast("int").alias("toxic"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return scores(docs, fit(docs, common.table(spark, sf_dir, "labels")))
