"""Operator 2: quality of whole documents by attention over their passages, learned from document labels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, labelled
from .attention import FEATURES, GatedAttention

#: Labelled documents that the model is fitted on, at most.
MOST_LABELLED = 4000
#: A document is good from this score on.
CUT = 0.3


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_LABELLED) -> GatedAttention | None:
    """The model, from at most `most` labelled documents that aren't held out; None without labels of both kinds.

    Passages are described by Spark tasks; the driver gets their features (540 bytes for 64 words) and fits in numpy.
    """
    common.prepare(docs.sparkSession)

    def features(batches):
        from ledgerloom.llm import attention

        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                x, n = attention.passages(part.column(1).to_pylist())
                cut = np.split(x, np.cumsum(n)[:-1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.tobytes() for c in cut], pa.binary()), part.column(2)], ["id", "x", "y"])

    rows = labelled.sample(docs, labels, [label_col], most, id_col, text_col).select(id_col, text_col, F.col(f"label_{label_col}").cast("double").alias("y"))
    kind = docs.schema[id_col].dataType.simpleString()
    got = rows.mapInArrow(features, f"id {kind}, x binary, y double").toPandas()
    if got["y"].nunique() < 2:
        return None
    got = got.sort_values("id", kind="stable")
    x = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in got["x"]]
    return GatedAttention.fit(np.concatenate(x).astype(np.float64), np.array([len(b) for b in x]), got["y"].to_numpy())


def scores(docs: DataFrame, model: GatedAttention | None, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """(id, held_out, score, predicted, passages, attention) of every document row.

    All passages of a text count; a null text counts as empty, and an empty one as one passage of zeros. Without a model
    every score is 0.5. attention is the largest weight of a passage. Other columns are not read.
    """
    common.prepare(docs.sparkSession)

    def run(batches):
        from ledgerloom.llm import attention

        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                x, n = attention.passages(part.column(1).to_pylist())
                s, a = model.score(x, n) if model else (np.full(len(n), 0.5), 1 / n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s, pa.float64()), pa.array(n, pa.int64()), pa.array(a, pa.float64())], [id_col, "score", "passages", "attention"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double, passages long, attention double")
    return out.select(id_col, labelled.held_out(id_col).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "passages", "attention")


def keep(docs: DataFrame, model: GatedAttention | None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of docs, all columns as they are, whose score isn't below `cut`; in one pass."""
    common.prepare(docs.sparkSession)
    if model is None:
        return docs
    at_col = docs.columns.index(text_col)

    def run(batches):
        from ledgerloom.llm import attention

        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                s, _ = model.score(*attention.passages(part.column(at_col).to_pylist()))
                yield part.filter(pa.array(s >= cut))

    return docs.mapInArrow(run, docs.schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return scores(docs, fit(docs, common.table(spark, sf_dir, "labels")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on those of `docs` that have labels, doesn't reject."""
    return keep(docs, fit(docs, common.table(spark, sf_dir, "labels")))
