"""What the operators of this folder share: tables, shared scratch space, held-out folds, shipping code."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
#: Rows in one Arrow batch. Whole texts travel in them, so far fewer than Spark's 10,000.
BATCH_ROWS = 1000
#: The column that with_key adds.
KEY = "_row_key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet")) if name == "documents" else spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores where it comes in fewer than half as many parts, as from one small file; else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def prepare(spark: SparkSession) -> None:
    """Bounds Arrow batches and sends this package to executors that can't import it."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    paths = {os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(":") if p} | {os.getcwd()}
    sc = spark.sparkContext
    if str(ROOT) in paths or os.path.realpath(ROOT) in paths or getattr(sc, "_ledgerloom_sent", False):
        return
    to = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-"), "ledgerloom_code.zip")
    with zipfile.ZipFile(to, "w") as out:
        for p in sorted((ROOT / "ledgerloom").rglob("*.py")):
            out.write(p, p.relative_to(ROOT))
    sc.addPyFile(to)
    sc._ledgerloom_sent = True


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the folder that the cluster shares; where none is set, one of this machine, if all of Spark runs here."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="ledgerloom-ck-"))
    return f"{sc._jsc.sc().getCheckpointDir().get()}/{what}-{uuid.uuid4().hex}"


def persist(df: DataFrame, what: str) -> DataFrame:
    """df as a written table of the shared folder: lineage ends, a lost executor loses nothing."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what persist wrote, once nothing reads it any more."""
    remove(df.sparkSession, df._written)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store that Spark reaches."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def with_key(df: DataFrame) -> DataFrame:
    """df as a written table with a number for each row, so that the number stays the same in all that reads it."""
    return persist(df.select("*", F.monotonically_increasing_id().alias(KEY)), "keyed")


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))
