"""Tables of recorded filings: a filing's rows change in one commit, steps that belong together in one write.

A table is a folder of partitions by `bucket`, a hash of the filing, so all rows of a filing lie in one of them. A write
replaces whole partitions by dynamic overwrite: rows are staged, and only the commit puts them in place. A write that fails
leaves the old rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lists, selectors, store

#: Partitions of a table. At 100 TB take more: a commit rewrites the partitions of its filings.
BUCKETS = 64


def _bucketed(rows: DataFrame, filing: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(filing), F.lit(buckets)).cast("int"))


def create(rows: DataFrame, at: str, filing: str, buckets: int = BUCKETS) -> None:
    """A new table. Large partitions are written by several tasks."""
    _bucketed(rows, filing, buckets).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(at)


def _touched(rows: DataFrame, filing: str, buckets: int) -> list[int]:
    """Partitions that filings lie in: at most as many numbers as there are partitions."""
    return sorted(r[0] for r in _bucketed(rows.select(filing), filing, buckets).select("bucket").distinct().collect())


def _replace(after: DataFrame, at: str, filing: str, buckets: int) -> None:
    rows = _bucketed(after, filing, buckets).hint("rebalance", "bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(at)


def read(spark: SparkSession, at: str) -> DataFrame:
    return spark.read.parquet(at).drop("bucket")


def record(at: str, reading: DataFrame, finished: DataFrame, keys: list[str], filing: str, unread: DataFrame, buckets: int = BUCKETS) -> None:
    """Puts readings of some filings in place of their earlier rows; keys include the filing.

    Only filings whose reading finished change. Rows that it no longer gives become `rejected`, but those of groups that
    weren't read this time (unread: filing, group_key) stay as they are. Only the partitions of these filings are read
    and written.
    """
    spark = reading.sparkSession
    touched = _touched(finished, filing, buckets)
    if touched:
        stored = spark.read.parquet(at).where(F.col("bucket").isin(touched)).drop("bucket")
        _replace(lists.recorded(stored, reading, finished, keys, filing, unread), at, filing, buckets)


class Held:
    """Writes of several steps over a table, until they are released together or dropped.

    Each step may read `now`, the table as its predecessors left it; nothing is stored before release.
    """

    def __init__(self, spark: SparkSession, at: str, keys: list[str], fields: list[str], filing: str, buckets: int = BUCKETS) -> None:
        self.spark, self.at, self.keys, self.fields, self.filing, self.buckets = spark, at, keys, fields, filing, buckets
        self.steps: list[DataFrame] = []

    def stored(self) -> DataFrame:
        return read(self.spark, self.at)

    def now(self) -> DataFrame:
        return self._with(selectors.batch_writes([self.stored(), *self.steps], self.keys, self.fields)) if self.steps else self.stored()

    def _with(self, changed: DataFrame, stored: DataFrame | None = None) -> DataFrame:
        stored = self.stored() if stored is None else stored
        return store.upsert(stored.select(*self.keys, *self.fields), changed, self.keys, F.lit(False), F.lit(True))

    def write(self, rows: DataFrame) -> None:
        self.steps.append(rows.select(*self.keys, *self.fields))

    def discard(self) -> None:
        self.steps = []

    def release(self, mark: str | None = None, value=None) -> None:
        """One write of what all steps come to: only rows that end different from the stored ones, and only their partitions.

        mark: a column of the table that rows changed by this release get a value in (a version, a time); others keep theirs.
        """
        from .joins import cut

        changed = cut(selectors.batch_writes([self.stored(), *self.steps], self.keys, self.fields))
        touched = _touched(changed, self.filing, self.buckets)
        if touched:
            stored = self.spark.read.parquet(self.at).where(F.col("bucket").isin(touched)).drop("bucket")
            rows = self._with(changed, stored)
            if mark:
                new, old = changed.select(*self.keys, F.lit(value).alias("_new")), stored.select(*self.keys, F.col(mark).alias("_old"))
                rows = rows.join(new, self.keys, "left").join(old, self.keys, "left").withColumn(mark, F.coalesce("_new", "_old")).drop("_new", "_old")
            _replace(rows, self.at, self.filing, self.buckets)
        self.discard()
