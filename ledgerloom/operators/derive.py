"""Periods that nobody reports, from those that are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def pivoted(df: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """One row for each key and year, with a column for each period."""
    pick = lambda p: F.sum(F.when(F.col(period) == p, F.col(value))).alias(p)
    return df.groupBy(*keys).agg(*[pick(p) for p in (*QUARTERS, "FY")])


def missing_periods(wide: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fiscal_period, value, method): the one period that the four others give.

    Q4 is the year less three quarters (any one quarter likewise), FY the sum of four. Two gaps give nothing.
    """
    year = F.col("FY")
    rest = lambda p: year - sum(F.col(q) for q in QUARTERS if q != p)
    ways = [F.when(F.col(p).isNull() & rest(p).isNotNull(), F.struct(F.lit(p).alias("fiscal_period"), rest(p).alias("value"))) for p in QUARTERS]
    total = F.col("Q1") + F.col("Q2") + F.col("Q3") + F.col("Q4")
    ways.append(F.when(year.isNull() & total.isNotNull(), F.struct(F.lit("FY").alias("fiscal_period"), total.alias("value"))))
    return wide.select(*keys, F.explode(F.array_compact(F.array(*ways))).alias("_w")).select(*keys, "_w.*", F.lit("derived").alias("method"))


def fourth_quarter(years: DataFrame, nine: DataFrame, keys: list[str], value: str, most_apart: int = 200) -> DataFrame:
    """Year less nine months by line, of filings at most so many days apart; per-share lines are never subtracted."""
    n = nine.select(*keys, F.col(value).alias("_nine"), F.col("filed").alias("_filed"))
    both = years.join(n, keys).where((F.abs(F.date_diff("filed", "_filed")) <= most_apart) & (F.col("unit") != "per_share"))
    return both.withColumn(value, F.col(value) - F.col("_nine")).drop("_nine", "_filed")


def publishable(keys: list[str], ok: Column) -> Column:
    """True where all parts of the group are verified."""
    from pyspark.sql import Window

    return F.bool_and(ok).over(Window.partitionBy(*keys))
