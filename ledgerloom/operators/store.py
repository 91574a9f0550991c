"""Versions, merges and changes of stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import newest_per_key


def last_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key of a batch of writes: the last."""
    return newest_per_key(df, keys, order)


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], locked: Column, wins: Column) -> DataFrame:
    """Stored rows with incoming ones merged in. Conditions speak of columns o (stored) and n (incoming), both structs.

    A stored row that is locked stays; else the incoming row replaces it where it wins.
    """
    rest = [c for c in stored.columns if c not in keys]
    o = stored.select(*keys, F.struct(*rest).alias("o"))
    n = incoming.select(*keys, F.struct(*rest).alias("n"))
    both = o.join(n, keys, "full")
    row = F.when(F.col("o").isNull(), F.col("n")).when(F.col("n").isNull() | F.coalesce(locked, F.lit(False)), F.col("o")).when(wins, F.col("n")).otherwise(F.col("o"))
    return both.select(*keys, row.alias("_r")).select(*keys, "_r.*")


def changes(before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, change): added, removed or changed between two snapshots; equal rows are left out."""
    b, a = before.select(*keys, F.struct(*fields).alias("_b")), after.select(*keys, F.struct(*fields).alias("_a"))
    kind = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return b.join(a, keys, "full").withColumn("change", kind).where("change IS NOT NULL").select(*keys, "change")


def to_read(sources: DataFrame, units: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Sources without a complete unit of the same context and reader version."""
    done = units.where(F.col("complete") & (F.col("version") == version)).select(*keys).distinct()
    return sources.join(done, keys, "left_anti")
