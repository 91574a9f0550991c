"""The test tables in terms of the domain: revenue values by segment and quarter, publication events, documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Registry:
    """Queries of one module and their SQL, filled by a decorator."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one of texts that comes in few parts, as from one small file, is dealt to all cores."""
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in ("documents", "pages") and 2 * df.rdd.getNumPartitions() <= cores else df


def dealt(df: DataFrame) -> DataFrame:
    """Rows that cost much for their few bytes, dealt to all cores: files and joined parts of a few MB would be one task each."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def money(name: str):
    """Amounts add up exactly as decimals."""
    return F.col(name).cast("decimal(18,2)")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with day, fiscal_year, fiscal_period and amount."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", day.alias("day"), F.year(day).alias("fiscal_year"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("fiscal_period"), money("o_totalprice").alias("amount"),
    )


def segment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's segment and nation."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    return orders(spark, sf_dir).join(c, "o_custkey")


def segment_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(segment, fiscal_year, fiscal_period, value): revenue of each quarter."""
    return segment_orders(spark, sf_dir).groupBy("segment", "fiscal_year", "fiscal_period").agg(F.sum("amount").alias("value"))


#: The same in SQL, for the queries' oracles.
ORDERS_SQL = """
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
  'Q' || quarter(o_orderdate) AS fiscal_period, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
s AS (SELECT o.*, c_mktsegment AS segment, c_nationkey AS nation FROM o JOIN customer ON o_custkey = c_custkey),
q AS (SELECT segment, fiscal_year, fiscal_period, sum(amount) AS value FROM s GROUP BY ALL)"""
