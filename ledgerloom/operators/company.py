"""A company's dimension rows, its earlier filer, the naming of its years, and which presentations are of one period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import vote
from .windows import islands

FOREIGN_FORMS = ("20-F", "40-F", "6-K")
#: Days by which two ends of one period may differ.
SAME_PERIOD_DAYS = 6


def profiles(filings: DataFrame, key: str, day: str = "filingDate", form: str = "form") -> DataFrame:
    """(key, name, fiscal_year_end, foreign, first_filed, last_filed) of each company: name and year end as of its newest filing, foreign if that or any form is one that only foreign companies file."""
    newest = F.struct(F.col(day), F.coalesce("accessionNumber", F.lit("")))
    last = lambda c: F.max_by(c, newest)
    foreign = F.bool_or(F.col(form).isin(*FOREIGN_FORMS))
    return filings.groupBy(key).agg(last("name").alias("name"), last("fiscalYearEnd").alias("fiscal_year_end"), F.coalesce(foreign, F.lit(False)).alias("foreign"), F.min(day).alias("first_filed"), F.max(day).alias("last_filed"))


def before_first(current: DataFrame, earlier: DataFrame, keys: list[str], day: str, accession: str) -> DataFrame:
    """An earlier filer's filings from before the current one's first, all of them where that has none; never one that both list."""
    first = current.groupBy(*keys).agg(F.min(day).alias("_first"))
    own = earlier.join(current.select(*keys, accession), [*keys, accession], "left_anti").join(first, keys, "left")
    return own.where(F.col("_first").isNull() | (F.col(day) < F.col("_first"))).select(*earlier.columns)


def same_period(presentations: DataFrame, keys: list[str], end: str, filed: str, dated: Column) -> DataFrame:
    """Presentations with `reference`, the end of their period, and `same`: whether each ends within SAME_PERIOD_DAYS of it.

    The reference is the end of the newest presentation that is dated itself, else the end that most share, ties to the newest
    filing and then to the later end.
    """
    counts = presentations.groupBy(*keys, end).agg(F.count("*").alias("_n"), F.max(filed).alias("_f"), F.max(F.when(dated, F.col(filed))).alias("_d"))
    best = F.max_by(end, F.struct(F.col("_d").isNotNull(), F.coalesce("_d", "_f"), "_n", end))
    most = F.max_by(end, F.struct("_n", "_f", end))
    reference = counts.groupBy(*keys).agg(F.when(F.count("_d") > 0, best).otherwise(most).alias("reference"))
    return presentations.join(reference, keys).withColumn("same", F.abs(F.date_diff(F.col(end), F.col("reference"))) <= SAME_PERIOD_DAYS)


def era_naming(years: DataFrame, votes: DataFrame, keys: list[str], end: str, mmdd: str, offset: str, filed: str) -> DataFrame:
    """(keys, era, first_end, last_end, mmdd, naming): runs of years that close on one day, and what each run adds to the calendar year to name its own.

    votes: keys, end, offset and filed of periods whose filings name their year; each is a vote in the run whose years hold it, the
    first run that ends on or after it, else the last. A run without votes takes the naming of the nearest run before it, else after it, else 0.
    """
    runs = islands(years.select(*keys, end, mmdd), keys, [F.col(end)], mmdd, "era")
    eras = runs.groupBy(*keys, "era", mmdd).agg(F.min(end).alias("first_end"), F.max(end).alias("last_end"))
    # each vote and each run's last end in one order: a vote belongs to the next end that follows it
    ends = eras.select(*keys, F.col("last_end").alias("_at"), F.col("era"), F.lit(None).cast("int").alias("_o"), F.lit(None).cast("date").alias("_f"))
    asked = votes.select(*keys, F.col(end).alias("_at"), F.lit(None).cast("int").alias("era"), F.col(offset).cast("int").alias("_o"), F.col(filed).cast("date").alias("_f"))
    in_order = Window.partitionBy(*keys).orderBy("_at", F.col("era").isNotNull())
    following = F.first("era", ignorenulls=True).over(in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    held = ends.unionByName(asked).withColumn("_era", F.coalesce(following, F.max("era").over(Window.partitionBy(*keys)))).where("era IS NULL AND _era IS NOT NULL")
    named = vote(held.select(*keys, F.col("_era").alias("era"), "_o", F.lit(1).alias("_w"), "_f"), [*keys, "era"], "_o", "_w", "_f").select(*keys, "era", F.col("_o").alias("_own"))
    out = eras.join(named, [*keys, "era"], "left")
    w = Window.partitionBy(*keys).orderBy("era")
    before = F.last("_own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("_own", ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return out.withColumn("naming", F.coalesce(before, after, F.lit(0))).select(*keys, "era", "first_end", "last_end", mmdd, "naming")
