"""Window operators over ordered series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def repeats_previous(df: DataFrame, keys: list[str], day: str, value: str, most_days: int = 120) -> Column:
    """Whether a value equals that of the period before, if that is near."""
    w = Window.partitionBy(*keys).orderBy(day)
    return F.coalesce((F.col(value) == F.lag(value).over(w)) & (F.date_diff(F.col(day), F.lag(day).over(w)) <= most_days), F.lit(False))


def contradicted_by_neighbours(keys: list[str], order: list[str], value: str, agree: float = 0.01, apart: float = 0.5) -> Column:
    """Whether both neighbours agree with each other but not with the value between."""
    w = Window.partitionBy(*keys).orderBy(*order)
    a, b, x = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    same = F.abs(a - b) <= agree * F.greatest(F.abs(a), F.abs(b))
    return F.coalesce(same & (F.abs(x - a) > apart * F.abs(a)) & (F.abs(x - b) > apart * F.abs(b)), F.lit(False))


def islands(df: DataFrame, keys: list[str], order: list[Column], value: str, name: str = "island") -> DataFrame:
    """Numbers runs of equal values, from 1: a new one begins where the value changes."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("_new")


def capped(df: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """At most so many rows of each key; a sampling operator."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def spot_checked(df: DataFrame, key: str, every: int = 10) -> DataFrame:
    """About one row in `every`, the same ones in each run, by the first 32 bits of the key's MD5; a sampling operator."""
    return df.where(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % every == 0)


def intervals(df: DataFrame, keys: list[str], order: list[Column], available: str) -> DataFrame:
    """Effective-dated rows: available_to is when the key's next row becomes available, null for the current one."""
    return df.withColumn("available_to", F.lead(available).over(Window.partitionBy(*keys).orderBy(*order)))


def running(keys: list[str], order: list[str], value: str) -> Column:
    return F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def filled(keys: list[str], order: list[str], value: str) -> Column:
    """The last value that isn't null, in order."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
