"""Operator 8: token ids of documents as binary files with Elias-Fano document boundaries.

A set of files is a folder. Each row of `segments` is one file image: a header, the boundaries of its documents in the
id array (Elias-Fano), their doc_ids (Elias-Fano over the distance from the first), the ids as 16 or 32-bit little-endian
numbers. `part` and `first` place a segment: all ids of lower parts come before it, then `first` ids of its own part. The
parts' totals are a table with one row for each written partition, so offsets are known without passing over the ids.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common
from .eliasfano import Sequence, pack

END_ID = 2
#: Ids after which a segment closes; documents stay whole, so one very long document may exceed it.
SEGMENT_IDS = 1_000_000
#: Documents that are encoded together.
STEP = 500
#: Parts at most; their totals (16 bytes each) are broadcast when files are read.
MOST_PARTS = 100_000
_HEAD = struct.Struct("<4sHBxQQqQ")  # magic, version, bytes of an id, ids, documents, first doc_id, null doc_ids
_MAGIC = b"LLTK"


def image(doc_ids: list[int | None], sizes: list[int], ids: bytes, width: int) -> bytes:
    """One file. Null doc_ids come first, the others ascend; ids: all ids as 32-bit numbers."""
    known = [x for x in doc_ids if x is not None]
    base = known[0] if known else 0
    bounds = np.concatenate([[0], np.cumsum(np.asarray(sizes, dtype=np.int64))])
    head = _HEAD.pack(_MAGIC, 1, width, int(bounds[-1]), len(doc_ids), base, len(doc_ids) - len(known))
    body = ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return head + pack(bounds) + pack(np.array([x - base for x in known], dtype=np.uint64)) + body


class TokenFile:
    """Reads one image in place."""

    def __init__(self, data: bytes) -> None:
        magic, version, self.width, self.n_ids, self.n_docs, self.base, self.nulls = _HEAD.unpack_from(data)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a token file")
        self.bounds = Sequence(data, _HEAD.size)
        self.names = Sequence(data, _HEAD.size + self.bounds.size)
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, _HEAD.size + self.bounds.size + self.names.size)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.names.all() + self.base).tolist()

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, by two selects."""
        return self.ids[self.bounds.get(i) : self.bounds.get(i + 1)]


@lru_cache(maxsize=1)
def _forms(path: str | None) -> bpe.WordForms:
    return bpe.WordForms(bpe.load(path), lambda ids: struct.pack(f"<{len(ids)}I", *ids))


def write(docs: DataFrame, to: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, parts: int | None = None, end_id: int = END_ID) -> None:
    """Encodes every text and writes the files below `to`, in ascending order of a whole-number id column.

    Null ids come first; rows with equal ids follow each other in an order fixed by their texts. Null and empty texts
    hold the end id only. No rows: no segments. Other columns are not read. Documents are dealt by id range and
    by text within an id, so repeated ids don't meet in one task.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    parts = min(MOST_PARTS, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    end = struct.pack("<I", end_id)

    def run(batches):
        from pyspark import TaskContext

        from ledgerloom.llm import bpe as worker
        from ledgerloom.llm import op8_token_files as own

        forms = own._forms(path)
        width = 2 if max(worker.load(path).size, end_id + 1) <= 1 << 16 else 4
        part, first, names, sizes, held, n = TaskContext.get().partitionId(), 0, [], [], [], 0

        def segment():
            row = [[part], [first], [len(names)], [n], [own.image(names, sizes, b"".join(held), width)]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["part", "first", "n_docs", "n_ids", "image"])

        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                step = batch.slice(at, STEP)
                for name, words in zip(step.column(0).to_pylist(), forms.coded(step.column(1).to_pylist())):
                    coded = b"".join(words) + end
                    names.append(name)
                    sizes.append(len(coded) // 4)
                    held.append(coded)
                    n += sizes[-1]
                    if n >= own.SEGMENT_IDS:
                        yield segment()
                        first, names, sizes, held, n = first + n, [], [], [], 0
        if names:
            yield segment()

    tie = F.xxhash64(common.text_of(text_col))
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), tie.alias("tie")).repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    rows = ordered.select("doc_id", "text").mapInArrow(run, "part int, first long, n_docs long, n_ids long, image binary")
    rows.write.option("compression", "zstd").parquet(f"{to}/segments")


def read(spark: SparkSession, at: str) -> DataFrame:
    """The segments with `start`, the ids of all segments before each."""
    segments = spark.read.parquet(f"{at}/segments")
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = _bases(totals)
    return segments.join(F.broadcast(bases), "part").select("part", "n_docs", "n_ids", (F.col("base") + F.col("first")).alias("start"), "image")


def _bases(totals: DataFrame) -> DataFrame:
    """part and the ids before it. The totals are at most MOST_PARTS rows, so one window may hold them."""
    from pyspark.sql import Window

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base"))


def documents(spark: SparkSession, at: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens) of each document and its ids as array<int>, or with digest their crc32."""
    common.prepare(spark)

    def run(batches):
        from ledgerloom.llm import op8_token_files as own

        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                f = own.TokenFile(data.as_py())
                bounds = f.bounds.all()
                if digest:
                    wide = memoryview(f.ids.astype("<u4").tobytes())
                    last = pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(f.ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids(), pa.int64()), pa.array(bounds[:-1] + start), pa.array(np.diff(bounds)), last], ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return read(spark, at).select("start", "image").mapInArrow(run, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = common.scratch(spark, "token-files")
    write(common.table(spark, sf_dir, "documents"), at)
    return documents(spark, at, digest=True)
