"""Joins by tolerance, by time and by order of appearance, kept as equi-joins on buckets so that they hash and shuffle."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share; where none is set, one of this machine, if all of Spark runs here."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="ledgerloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder, so that what follows doesn't plan or compute it again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def newest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order that ends in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def within_days(left: DataFrame, right: DataFrame, keys: list[str], left_day: str, right_day: str, days: int, shift: int = 0) -> DataFrame:
    """Inner join on keys where right_day is within `days` of left_day + shift. Columns besides keys differ in name.

    The right side is keyed by a bucket of days; the left one asks for the two or three buckets its window meets.
    """
    width = 2 * days + 1
    bucket = lambda d: F.floor(F.unix_date(d) / width)
    at = F.date_add(F.col(left_day), shift)
    asks = left.withColumn("_b", F.explode(F.sequence(bucket(F.date_sub(at, days)), bucket(F.date_add(at, days)))))
    has = right.withColumn("_b", bucket(F.col(right_day)))
    out = asks.join(has, [*keys, "_b"]).drop("_b")
    return out.where(F.abs(F.date_diff(F.col(right_day), F.date_add(F.col(left_day), shift))) <= days)


def within_ratio(left: DataFrame, right: DataFrame, keys: list[str], left_value: str, right_value: str, tolerance: float) -> DataFrame:
    """Inner join on keys where |left - right| <= tolerance * left, for positive values and a tolerance below 1.

    Both are bucketed by their logarithm; values within tolerance are in equal or neighbouring buckets.
    """
    import math

    width = -math.log1p(-tolerance) * 1.01
    bucket = lambda v: F.floor(F.ln(F.col(v)) / width)
    asks = left.where(F.col(left_value) > 0).withColumn("_b", F.explode(F.sequence(bucket(left_value) - 1, bucket(left_value) + 1)))
    has = right.where(F.col(right_value) > 0).withColumn("_b", bucket(right_value))
    return asks.join(has, [*keys, "_b"]).drop("_b").where(F.abs(F.col(left_value) - F.col(right_value)) <= tolerance * F.col(left_value))


def previous(df: DataFrame, keys: list[str], day: str, order: list[Column], columns: dict[str, str], most_days: int) -> DataFrame:
    """As-of backward join of a table with itself: columns of the row before, null if that is more than most_days ago."""
    w = Window.partitionBy(*keys).orderBy(*order)
    near = F.date_diff(F.col(day), F.lag(day).over(w)) <= most_days
    return df.withColumns({new: F.when(near, F.lag(old).over(w)) for old, new in columns.items()})


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, columns: list[str]) -> DataFrame:
    """For each left row the columns of the last right row at or before its time, by one union and one running last()."""
    extra = [c for c in left.columns if c not in keys]
    l = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*extra).alias("_l"), F.lit(None).cast(right.select(F.struct(*columns)).schema[0].dataType).alias("_r"))  # noqa: E741
    r = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(l.schema["_l"].dataType).alias("_l"), F.struct(*columns).alias("_r"))
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    out = l.union(r).withColumn("_r", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    return out.select(*keys, "_l.*", *[F.col(f"_r.{c}").alias(f"asof_{c}") for c in columns])


def occurrence(df: DataFrame, keys: list[str], order: list[Column], name: str = "occurrence") -> DataFrame:
    """Which repeat of its keys each row is, from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int"))


def only_pairs(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs of which either side has no other."""
    l, r = Window.partitionBy(left), Window.partitionBy(right)  # noqa: E741
    return pairs.withColumn("_l", F.count("*").over(l)).withColumn("_r", F.count("*").over(r)).where("_l = 1 AND _r = 1").drop("_l", "_r")


def one_to_one(pairs: DataFrame, left: str, right: str, score: str) -> DataFrame:
    """Greedy matching until no pair is left: in each round the pairs that are best for both sides are taken, their sides leave.

    Ties go to the lower left and then the lower right. Where all of some lefts and all of some rights tie for best with
    each other and with no one else, they are matched by rank in one round.
    """
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    left_, taken, rounds = cut(pairs.groupBy(left, right).agg(F.max(score).alias(score))), None, 0
    while taken is None or not left_.isEmpty():
        d = left_
        for side, mine, other in (("l", left, right), ("r", right, left)):
            w = Window.partitionBy(mine)
            d = d.withColumn(f"_{side}", F.row_number().over(w.orderBy(F.col(score).desc(), F.col(other)))).withColumn(f"_{side}top", F.max(score).over(w))
        d = d.withColumn("_tied", F.coalesce((F.col(score) == F.col("_ltop")) & (F.col(score) == F.col("_rtop")), F.lit(False)))
        for side, mine, other in (("l", left, right), ("r", right, left)):
            w = Window.partitionBy(mine)
            tops, ties = F.count_if(F.col(score) == F.col(f"_{side}top")).over(w), F.count_if("_tied").over(w)
            mates = [F.sum(F.when(F.col("_tied"), F.xxhash64(F.lit(k), other).cast("decimal(38,0)"))).over(w) for k in (1, 2)]
            d = d.withColumn(f"_{side}set", F.struct((tops == ties).alias("own"), ties.alias("n"), mates[0].alias("a"), mates[1].alias("b")))
        for side, mine, theirs in (("l", left, "_rset"), ("r", right, "_lset")):
            x = F.when(F.col("_tied"), F.col(theirs))
            d = d.withColumn(f"_{side}same", F.min(x).over(Window.partitionBy(mine)) == F.max(x).over(Window.partitionBy(mine)))
        # tied pairs come first on either side, so a place among all pairs is the rank within the block
        block = F.col("_tied") & F.col("_lsame") & F.col("_rsame") & F.col("_lset.own") & F.col("_rset.own")
        best = d.where((F.col("_l") == F.col("_r")) & ((F.col("_l") == 1) | block)).select(left, right, score)
        best = cut(best)
        taken, rounds = best if taken is None else taken.union(best), rounds + 1
        if rounds % 16 == 0:
            taken = cut(taken)
        gone_l, gone_r = best.select(F.col(left).alias("_x")), best.select(F.col(right).alias("_y"))
        left_ = left_.join(gone_l, same(left, "_x"), "left_anti").join(gone_r, same(right, "_y"), "left_anti")
        left_ = cut(left_)
    return taken
