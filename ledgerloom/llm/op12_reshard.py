"""Operator 12: resharding by minimum-cost flow.

A sharded dataset is a folder: `data/version=V/shard=S/file=F` hold the rows, and the newest table below `manifest` says for
each block (a run of rows of one file) in which version and shard it lies and how many rows of its shard come before it.
Resharding solves which bytes go from which shard to which, picks whole blocks for them, and writes the files that
lose blocks anew, each block below its shard; other files stay untouched. The new manifest's commit is what makes a
version valid: until then, and after a failure, the version before is whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from . import common
from .flow import placed, transfers

#: Shards that documents arrive in, and those that the query makes of them.
OLD_SHARDS, NEW_SHARDS = 32, 40
#: Bytes that a row counts beside its text.
ROW_BYTES = 16
#: Blocks of an even shard: one block is about 1.6 % of it.
BLOCKS = 64
#: Files of an even shard, where the input's parts are fewer.
FILES = 4
#: Parts that are written at most. Blocks number at most 2 * BLOCKS * shards and one for each file; the driver holds their sizes.
MOST_PARTS = 20_000
#: Of the data's files. Snappy's buffers lie outside the heap until it is collected, and many small files fill them without filling the heap.
CODEC = "zstd"
_PLACE = StructType([StructField("run", IntegerType()), StructField("block", IntegerType()), StructField("row", LongType())])
_MANIFEST = "file long, block int, version int, shard int, n_rows long, bytes long, start long"


def size_of(text_col: str) -> Column:
    return (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + ROW_BYTES).cast("long")


def _place(block_bytes: int, file_bytes: int):
    """Run (file of a task), block and row within it of each row, from the sizes alone, in the order in which a task reads them."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        file, in_file, block, in_block, row = 0, 0, 0, 0, -1
        for sizes in batches:
            out = np.zeros((3, len(sizes)), dtype=np.int64)
            for i, size in enumerate(sizes.to_pylist()):
                if row >= 0 and in_file >= file_bytes:
                    file, in_file, block, in_block, row = file + 1, 0, 0, 0, -1
                elif row >= 0 and in_block + size > block_bytes:
                    block, in_block, row = block + 1, 0, -1
                row, in_block, in_file = row + 1, in_block + size, in_file + size
                out[:, i] = file, block, row
            yield pa.StructArray.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2])], ["run", "block", "row"])

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, _PLACE).asNondeterministic()


def write(docs: DataFrame, at: str, shards: int, text_col: str = "text", even_shards: int | None = None) -> None:
    """docs as a sharded dataset in a new folder, without a shuffle: each task writes what it reads as files of whole blocks.

    Files are dealt to shards by their numbers' hashes, so sizes differ. Rows of any columns, also of clashing names and
    nulls, are kept as they are. A row larger than a block is a block. even_shards: the number that blocks are measured for.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    if docs.rdd.getNumPartitions() > MOST_PARTS:
        docs = docs.coalesce(MOST_PARTS)
    total = docs.agg(F.sum(size_of(text_col))).first()[0] or 0
    of = even_shards or shards
    rows = docs.select(size_of(text_col).alias("size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.withColumn("place", _place(max(1, total // (of * BLOCKS)), max(1, total // (of * FILES)))("size"))
    rows = rows.withColumn("file", F.shiftleft(F.spark_partition_id().cast("long"), 20) + F.col("place.run"))
    rows = rows.select("place.block", "place.row", "size", "doc", F.lit(0).alias("version"), F.pmod(F.xxhash64("file"), F.lit(shards)).cast("int").alias("shard"), "file")
    rows.write.option("compression", CODEC).partitionBy("version", "shard", "file").parquet(f"{at}/data")
    spark.createDataFrame([], _schema_of(docs)).coalesce(1).write.parquet(f"{at}/empty")
    held = _rows(spark, at, f"{at}/data").groupBy("file", "block", "version", "shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes")).toPandas()
    _commit(spark, at, 0, held)


def _schema_of(docs: DataFrame) -> StructType:
    return StructType([StructField("block", IntegerType()), StructField("row", LongType()), StructField("size", LongType()), StructField("doc", docs.schema)])


def _rows(spark: SparkSession, at: str, *paths: str) -> DataFrame:
    """Rows of some folders of data, with version, shard and file. No folders: no rows."""
    schema = spark.read.parquet(f"{at}/empty").schema
    for name, kind in (("version", IntegerType()), ("shard", IntegerType()), ("file", LongType())):
        schema = schema.add(name, kind)
    return spark.read.schema(schema).option("basePath", f"{at}/data").parquet(*paths) if paths else spark.createDataFrame([], schema)


def _commit(spark: SparkSession, at: str, version: int, blocks) -> None:
    """blocks, a pandas frame, as the manifest of a version; start: rows of a shard before a block."""
    blocks = blocks.sort_values(["shard", "file", "block"])
    blocks["start"] = blocks.groupby("shard")["n_rows"].cumsum() - blocks["n_rows"] if len(blocks) else []
    rows = blocks[[x.split()[0] for x in _MANIFEST.split(", ")]].itertuples(index=False, name=None)
    spark.createDataFrame([tuple(map(int, r)) for r in rows], _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{at}/manifest/version={version:06d}")


def manifest(spark: SparkSession, at: str) -> DataFrame:
    """The blocks of the newest version that was committed. A folder without _SUCCESS is none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}/manifest")
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(x.getPath().getName() for x in fs.listStatus(hadoop))
    whole = [n for n in names if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}/manifest/{n}/_SUCCESS"))]
    return spark.read.schema(_MANIFEST).parquet(f"{at}/manifest/{whole[-1]}").withColumn("current", F.lit(int(whole[-1].split("=")[1])))


def _folder(at: str, x) -> str:
    return f"{at}/data/version={x.version}/shard={x.shard}/file={x.file}"


def reshard(spark: SparkSession, at: str, room: list[int] | int, zones: list[int] | None = None) -> dict[str, int]:
    """Moves blocks to new shards: room is their number, for even sizes, or the bytes that each may hold.

    zones: the zone of each shard; of all ways that move the fewest bytes one with the fewest between zones is taken.
    Returns bytes: moved, least (what any way has to move) and rewritten (of the files that were written anew).
    """
    import pandas as pd

    blocks = manifest(spark, at).toPandas().sort_values(["shard", "file", "block"]).reset_index(drop=True)
    total = int(blocks["bytes"].sum())
    even = isinstance(room, int)
    room = [total // room + (j < total % room) for j in range(room)] if even else room
    shards = max([len(room), *(blocks["shard"] + 1)])
    old = np.bincount(blocks["shard"], weights=blocks["bytes"], minlength=shards).astype(np.int64).tolist() if len(blocks) else [0] * shards
    moves = transfers(old, room + [0] * (shards - len(room)), zones)
    to = placed(blocks["shard"].to_numpy(np.int64), blocks["bytes"].to_numpy(np.int64), moves, len(room)) if len(blocks) else np.zeros(0, np.int64)
    moved = to != blocks["shard"].to_numpy()
    version = int(blocks["current"].max()) + 1 if len(blocks) else 1
    touched = blocks["file"].isin(blocks.loc[moved, "file"].unique())
    gone = sorted({_folder(at, x) for x in blocks[touched].itertuples()})
    new = blocks.assign(shard=to, version=np.where(touched, version, blocks["version"]))
    if gone:
        plan = spark.createDataFrame(pd.DataFrame({"file": new.loc[touched, "file"].astype("int64"), "block": new.loc[touched, "block"].astype("int32"), "to": new.loc[touched, "shard"].astype("int32")}), "file long, block int, to int")
        rows = _rows(spark, at, *gone).join(F.broadcast(plan), ["file", "block"])
        rows.select("block", "row", "size", "doc", F.col("to").alias("shard"), "file").write.mode("overwrite").option("compression", CODEC).partitionBy("shard", "file").parquet(f"{at}/data/version={version}")
    _commit(spark, at, version, new)
    for path in gone:
        common.remove(spark, path)
    return {"moved": int(blocks.loc[moved, "bytes"].sum()), "least": sum(moves.values()), "rewritten": int(blocks.loc[touched, "bytes"].sum())}


def read(spark: SparkSession, at: str) -> DataFrame:
    """All rows of the newest version: doc (the row as it came), size, shard and slot, its place in the shard from 0."""
    blocks = manifest(spark, at)
    folders = sorted({_folder(at, x) for x in blocks.select("version", "shard", "file").distinct().toPandas().itertuples()})
    rows = _rows(spark, at, *folders).drop("version", "shard").join(F.broadcast(blocks.select("file", "block", "shard", "start")), ["file", "block"])
    return rows.select("doc", "size", "shard", (F.col("start") + F.col("row")).alias("slot"))


def op12_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents arrive in 32 shards of unlike sizes and are resharded to 40 of near equal bytes."""
    at = common.scratch(spark, "shards")
    write(common.table(spark, sf_dir, "documents"), at, OLD_SHARDS, even_shards=NEW_SHARDS)
    reshard(spark, at, NEW_SHARDS)
    text = F.coalesce(F.col("doc.text"), F.lit("")).cast("binary")
    return read(spark, at).select(
        "doc.doc_id", "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
