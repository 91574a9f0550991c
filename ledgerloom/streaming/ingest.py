"""Streams of events and filings. The same functions serve batch tables, which is how they are tested against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def events(spark: SparkSession, path: str, schema: str, time_col: str, late: str = "1 day") -> DataFrame:
    """Parquet files that arrive in a folder, with a watermark on their time."""
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, late)


def windowed(rows: DataFrame, time_col: str, keys: list[str], value: str, every: str = "1 day") -> DataFrame:
    """(keys, window_start, n, total) of tumbling windows."""
    w = F.window(time_col, every)
    return rows.groupBy(w, *keys).agg(F.count("*").cast("long").alias("n"), F.sum(value).alias("total")).select(*keys, F.col("window.start").alias("window_start"), "n", "total")


def sessions(rows: DataFrame, time_col: str, keys: list[str], gap: str = "30 minutes") -> DataFrame:
    """(keys, session_start, n) of sessions that a gap ends."""
    w = F.session_window(time_col, gap)
    return rows.groupBy(w, *keys).agg(F.count("*").cast("long").alias("n")).select(*keys, F.col("session_window.start").alias("session_start"), "n")


def publish(rows: DataFrame, table: str, keys: list[str], fields: list[str], available: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch's changed versions of keys to a table of versions; a late restatement never rewrites history.

    A version is new if it differs from its key's latest stored one. available_to isn't stored: it follows from the next
    version (operators.windows.intervals), so publishing only ever appends.
    """
    from pyspark.sql import Window

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = batch.select(*keys, *fields, available)
        if spark.catalog.tableExists(table):
            stored = spark.table(table)
            latest = stored.groupBy(*keys).agg(F.max_by(F.struct(*fields, available), F.col(available)).alias("_s")).join(own.select(*keys).distinct(), keys, "left_semi").select(*keys, "_s.*")
            own = own.withColumn("_new", F.lit(True)).union(latest.select(*own.columns).withColumn("_new", F.lit(False)))
        else:
            own = own.withColumn("_new", F.lit(True))
        w = Window.partitionBy(*keys).orderBy(available, "_new")
        before = F.lag(F.struct(*fields)).over(w)
        changed = own.withColumn("_b", before).withColumn("_k", F.row_number().over(w)).where(F.col("_new") & ((F.col("_k") == 1) | ~F.struct(*fields).eqNullSafe(F.col("_b"))))
        changed.select(*keys, *fields, available).withColumn("batch_id", F.lit(batch_id)).write.mode("append").saveAsTable(table)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
