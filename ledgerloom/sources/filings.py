"""Filing lists and regulators' feeds, from files of their own formats."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parallel arrays of a filing list.
LIST_FIELDS = ("accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "form", "items", "isXBRL", "primaryDocument", "size")


def filing_lists(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row for each filing of JSON filing lists (one object for each file, or with `lines` for each line), amendments included."""
    lists = spark.read.option("multiLine", not lines).json(path)
    have = {f.name for f in lists.select("filings.recent.*").schema}
    zipped = F.arrays_zip(*[F.col(f"filings.recent.{c}").alias(c) for c in LIST_FIELDS if c in have])
    rows = lists.select("cik", "name", "fiscalYearEnd", F.inline(zipped))
    return rows.withColumns({c: F.col(c).try_cast("date") for c in ("filingDate", "reportDate") if c in have})


def periodic(filings: DataFrame, since: Column, forms: tuple[str, ...] = ("10-Q", "10-K", "20-F", "40-F")) -> DataFrame:
    """Periodic reports since a day; amendments have other form names and fall out."""
    return filings.where(F.col("form").isin(*forms) & (F.col("filingDate") >= since))


def releases(filings: DataFrame, quarter_ends: DataFrame, most_days: int = 60) -> DataFrame:
    """Furnished filings with the quarter end they report; unconfirmed ones go where the quarter has a confirmed one.

    quarter_ends: cik and quarter_end. A filing belongs to the last quarter end at most so many days before it.
    """
    from ..operators.joins import newest_per_key, within_days

    own = filings.where(F.col("form").isin("8-K", "6-K"))
    near = within_days(own, quarter_ends, ["cik"], "filingDate", "quarter_end", most_days // 2, -(most_days // 2))
    near = newest_per_key(near, ["cik", "accessionNumber"], [F.desc("quarter_end")])
    near = near.withColumn("confirmed", F.coalesce(F.array_contains(F.split("items", ","), "2.02"), F.lit(False)))
    proved = near.where("confirmed").select("cik", "quarter_end").distinct().withColumn("_p", F.lit(True))
    return near.join(proved, ["cik", "quarter_end"], "left").where("confirmed OR _p IS NULL").drop("_p")


def statement_csv_zips(spark: SparkSession, path: str, sep: str = ";", encoding: str = "latin-1") -> DataFrame:
    """(path, member, line, fields) of every line of the CSV files in zip packages."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import pandas as pd

        for batch in batches:
            for where, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for member in sorted(n for n in z.namelist() if n.lower().endswith(".csv")):
                        lines = z.read(member).decode(encoding).splitlines()
                        yield pd.DataFrame({"path": where, "member": member, "line": range(len(lines)), "fields": [x.split(sep) for x in lines]})

    return files.mapInPandas(run, "path string, member string, line int, fields array<string>")


def xml_facts(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


def kept_or_fresh(fresh: DataFrame, kept: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The fresh copy of each key where there is one, else the kept copy."""
    both = fresh.select(*keys, F.col(column).alias("_f")).join(kept.select(*keys, F.col(column).alias("_k")), keys, "full")
    return both.select(*keys, F.coalesce("_f", "_k").alias(column))
