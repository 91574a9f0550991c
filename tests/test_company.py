"""Profiles, earlier filers, periods and namings on small tables with nulls and ties."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, company
from ledgerloom.plans import served

from .conftest import SF

d = dt.date


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_profiles(spark):
    schema = "cik string, name string, fiscalYearEnd string, accessionNumber string, filingDate date, form string"
    df = spark.createDataFrame([("1", "Old", "0630", "a", d(2020, 1, 1), "10-K"), ("1", "New", "1231", "b", d(2021, 1, 1), None), ("2", "F", "1231", None, d(2020, 1, 1), "6-K"), ("3", None, None, "c", None, "10-K")], schema)
    assert rows(company.profiles(df, "cik")) == [("1", "New", "1231", False, d(2020, 1, 1), d(2021, 1, 1)), ("2", "F", "1231", True, d(2020, 1, 1), d(2020, 1, 1)), ("3", None, None, False, None, None)]
    assert rows(company.profiles(df.limit(0), "cik")) == []


def test_before_first(spark):
    schema = "k string, day date, a string"
    now = spark.createDataFrame([("x", d(2020, 5, 1), "n1"), ("x", d(2021, 5, 1), "n2")], schema)
    old = spark.createDataFrame([("x", d(2019, 1, 1), "o1"), ("x", d(2020, 5, 1), "o2"), ("x", d(2018, 1, 1), "n2"), ("y", d(2030, 1, 1), "o3")], schema)
    assert rows(company.before_first(now, old, ["k"], "day", "a")) == [("x", d(2019, 1, 1), "o1"), ("y", d(2030, 1, 1), "o3")]


def test_same_period(spark):
    data = [("most", d(2020, 3, 31), d(2020, 5, 1), False), ("most", d(2020, 3, 31), d(2020, 5, 2), False), ("most", d(2020, 4, 27), d(2021, 1, 1), False), ("dated", d(2020, 3, 31), d(2020, 5, 1), False), ("dated", d(2020, 3, 31), d(2020, 5, 2), False), ("dated", d(2020, 4, 8), d(2020, 5, 1), True), ("tie", d(2020, 3, 28), d(2020, 5, 1), None), ("tie", d(2020, 3, 31), d(2020, 6, 1), None)]
    df = spark.createDataFrame(data, "k string, e date, f date, own boolean")
    out = {(r.k, r.e): (r.reference, r.same) for r in company.same_period(df, ["k"], "e", "f", F.col("own")).collect()}
    assert out[("most", d(2020, 4, 27))] == (d(2020, 3, 31), False) and out[("dated", d(2020, 3, 31))] == (d(2020, 4, 8), False) and out[("tie", d(2020, 3, 28))] == (d(2020, 3, 31), True)


def test_era_naming(spark):
    years = spark.createDataFrame([("x", d(y, 12, 31), "1231") for y in (2000, 2001)] + [("x", d(2003, 6, 30), "0630")] + [("z", d(2000, 12, 31), "1231")], "k string, e date, m string")
    votes = spark.createDataFrame([("x", d(2001, 3, 1), 1, d(2001, 4, 1)), ("x", d(2001, 6, 1), 0, d(2001, 7, 1)), ("x", d(2009, 6, 1), 2, d(2009, 7, 1)), ("q", d(2001, 1, 1), 5, d(2001, 1, 1))], "k string, e date, o int, f date")
    assert [(r.k, r.era, r.naming) for r in company.era_naming(years, votes, ["k"], "e", "m", "o", "f").orderBy("k", "era").collect()] == [("x", 1, 0), ("x", 2, 2), ("z", 1, 0)]


def test_top_level(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "gone"), ("e", "d")], "k string, p string")
    assert rows(aggregates.top_level(df, "k", "p")) == [("a", None), ("d", "gone")]


def test_pages_to_served_hold_misprints(spark):
    """Customers whose second filing doesn't add up keep the first one's lines."""
    out = served.pages_to_served(spark, SF)
    held = out.where("CAST(customer AS INT) % 4 = 0")
    assert held.count() > 0 and held.where("available_to IS NOT NULL").count() == 0
    assert out.where("CAST(customer AS INT) % 12 IN (3, 9, 6) AND line = 'Total orders' AND available_to IS NOT NULL").count() > 0
