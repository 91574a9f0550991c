"""Connected components of an edge table, all of it in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, persist

#: A node with more than this part of all edge ends is dealt to SALTS tasks; there are at most about 1 / HOT such nodes.
HOT, SALTS = 0.001, 64


def _sum_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, most: float) -> DataFrame:
    """edges with m, the least v of their u; the few u with more than `most` edges are joined by u and a salt."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hot = F.broadcast(least.where(F.col("n") > most).select("u", F.lit(SALTS).alias("salts")))
    salted = edges.join(hot, "u", "left").withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("v"), F.lit(SALTS))).cast("int"))
    copies = F.sequence(F.lit(0), F.when(F.col("n") > most, SALTS).otherwise(1) - 1)
    return salted.join(least.select("u", "m", F.explode(copies).alias("salt")), ["u", "salt"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node of its component; nodes without an edge to another are not listed.

    edges has columns u and v of one type. Rounds of large and small stars hang every node below its smallest neighbour
    until nothing changes, log-many rounds; each is a written table, so a lost executor loses one round at most.
    """
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, last = persist(now, "edges"), None
    while (size := _sum_of(now)) != last and size[0]:
        last = size
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * HOT * size[0]).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = persist(large.where("u <> v").distinct(), "stars")
        small = _with_least(large, HOT * size[0])
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        before, now = now, persist(small.where("u <> v").distinct(), "edges")
        discard(before), discard(large)
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
