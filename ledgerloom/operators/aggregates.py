"""Aggregations: votes, rollups without double counting, learned totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import newest_per_key


def vote(df: DataFrame, keys: list[str], choice: str, weight: str, newest: str) -> DataFrame:
    """The choice of most weight for each key, ties to the one seen last; with votes and the lead over the runner-up."""
    sums = df.groupBy(*keys, choice).agg(F.sum(weight).cast("long").alias("votes"), F.max(newest).alias("_newest"))
    w = Window.partitionBy(*keys).orderBy(F.desc("votes"), F.desc("_newest"), F.col(choice))
    ranked = sums.withColumn("_n", F.row_number().over(w)).withColumn("_next", F.lead("votes").over(w))
    return ranked.where("_n = 1").select(*keys, choice, "votes", (F.col("votes") - F.coalesce("_next", F.lit(0))).cast("long").alias("lead"))


def most_common(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, ties to the lowest."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return newest_per_key(n, keys, [F.desc("n"), F.col(value)])


def top_level(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Rows none of whose ancestors is a row itself; parents that are missing end a line.

    A line goes up through rows only, so a row has an ancestor among them if and only if its parent is one.
    """
    ids = df.select(F.col(key).alias("_k")).distinct()
    return df.join(ids, F.col(parent) == F.col("_k"), "left_anti")


def accuracy(df: DataFrame, expected: str, found: str, right: str) -> DataFrame:
    """One row: correct, wrong, missing, accuracy of what was found, recall of what was expected."""
    n = lambda c: F.count_if(c).cast("long")
    has, ok = F.col(found).isNotNull(), F.col(right)
    counts = df.agg(n(has & ok).alias("correct"), n(has & ~ok).alias("wrong"), n(~has).alias("missing"), F.count("*").alias("expected"))
    return counts.select("correct", "wrong", "missing", F.round(F.try_divide("correct", F.col("correct") + F.col("wrong")), 6).alias("accuracy"), F.round(F.try_divide("correct", "expected"), 6).alias("recall"))
