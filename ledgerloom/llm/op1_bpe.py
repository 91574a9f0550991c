"""Operator 1: BPE encoding and decoding of whole documents, with no shuffle."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import bpe, common

#: Texts whose words are encoded together.
STEP = 200


def _stepped(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            yield part.column(0), part.column(1).to_pylist()


@lru_cache(maxsize=1)
def _digest_forms(path: str | None) -> tuple[bpe.WordForms, dict[bytes, bytes]]:
    """Words as their ids in decimal, and each id as its token."""
    b = bpe.load(path)
    return bpe.WordForms(b, lambda ids: " ".join(map(str, ids)).encode()), {b"%d" % i: t.encode() for i, t in enumerate(b.tokens)}


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids array<int>) of every row; a null text counts as empty and gives an empty array.

    Repeated rows stay repeated, other columns are not read. A text is held by one task only while it is encoded.
    """
    common.prepare(docs.sparkSession)

    def run(batches):
        from ledgerloom.llm import bpe as worker

        b = worker.load(path)
        for ids, texts in _stepped(batches):
            coded = b.encode(texts)
            yield pa.RecordBatch.from_arrays([ids, pa.array(coded, pa.list_(pa.int32()))], [id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, decoded string) of every row; a null array counts as empty and gives an empty text."""
    common.prepare(coded.sparkSession)

    def run(batches):
        from ledgerloom.llm import bpe as worker

        b = worker.load(path)
        for ids, lists in _stepped(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array([b.decode(x or []) for x in lists], pa.string())], [id_col, "decoded"])

    kind = coded.schema[id_col].dataType.simpleString()
    return coded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded string")


def round_trip_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded again in one pass.

    The ids of a word are kept, so a repeated word costs one look-up. Null and empty texts have no
    tokens and the digests of an empty string.
    """
    common.prepare(docs.sparkSession)

    def run(batches):
        from ledgerloom.llm import op1_bpe as worker

        forms, token = worker._digest_forms(path)
        for ids, texts in _stepped(batches):
            n, coded, decoded = [], [], []
            for words in forms.coded(texts):
                x = b" ".join(words)
                own = x.split()
                n.append(len(own))
                coded.append(hashlib.sha256(x).hexdigest())
                decoded.append(hashlib.sha256(b" ".join(map(token.__getitem__, own))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(common.table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: the documents that are left, with what identifies their tokens."""
    return round_trip_digests(docs)
