"""Set operations on lists of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def added_removed(later: DataFrame, earlier: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change): lines of one presentation that the other lacks."""
    l, e = later.select(*keys).distinct(), earlier.select(*keys).distinct()  # noqa: E741
    return l.join(e, keys, "left_anti").withColumn("change", F.lit("added")).union(e.join(l, keys, "left_anti").withColumn("change", F.lit("removed")))


def only_adds(before: DataFrame, after: DataFrame, keys: list[str]) -> bool:
    """Whether the new list has all of the old one."""
    return before.select(*keys).join(after.select(*keys), keys, "left_anti").isEmpty()


def key_sets(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """(keys, members): the distinct members of each period, in order and joined, so that equal sets are equal strings."""
    return df.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(member)), ",").alias("members"))


def first_of_each(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of several lists, each key once: the earlier list goes first."""
    from functools import reduce

    from .joins import newest_per_key

    ranked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p.withColumn("_p", F.lit(k)) for k, p in enumerate(parts)])
    rest = [F.col(c) for c in ranked.columns if c not in keys and c != "_p"]
    return newest_per_key(ranked, keys, [F.col("_p"), *rest]).drop("_p")
