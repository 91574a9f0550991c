"""Column functions: what their literal cases, which are queries, can't show."""

import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import headers, labels, numbers


@pytest.mark.parametrize("text", [" " * 100_000 + "x", "- " * 50_000, "-" + " " * 100_000 + "x 5", "(" * 100_000, "1," * 50_000, "$ " * 50_000 + "7", "." * 100_000])
def test_numbers_take_time_in_proportion(spark, text):
    frame = spark.createDataFrame([(text,)], "t string")
    numbers_of = frame.select(numbers.parse_number(F.col("t")).alias("x"))
    numbers_of.collect()
    began = time.perf_counter()
    numbers_of.collect()
    assert time.perf_counter() - began < 2


def test_functions_of_nulls_and_empty_texts(spark):
    rows = spark.createDataFrame([(None, None), ("", []), (" ", [["", ""]])], "t string, rows array<array<string>>")
    t, table, one = F.col("t"), F.col("rows"), F.lit(1)
    got = rows.select(
        numbers.parse_number(t).alias("a"), labels.member_key(t).alias("b"), labels.row_line(t, t).alias("c"), labels.labels_agree(t, t).alias("d"), headers.column_header(table, one, one).alias("e"),
        headers.header_contradicts(table, one, one, F.current_date()).alias("f"), labels.title_case(t).alias("g"), labels.initials(t).alias("h"),
    ).collect()
    assert all(r["a"] is None and r["c"] is None and r["f"] is None and r["d"] for r in got)


def test_readers_take_time_in_proportion(spark):
    """100,000 characters of prose, figures and marks behind two years, in the readers that look for figures in running text."""
    from ledgerloom.operators import readers

    spark.range(1).select(F.lit("a 1 2").alias("text")).collect()
    prose = "Sales of the year were good and so it went on " * 2200
    texts = {"prose": prose, "figures": "Sales 1,234 5,678 " * 5500, "dashes": "Sales - — " * 10000, "letters": "a" * 100_000, "brackets": "(a $ " * 20000, "digits": "9" * 100_000, "years": "2024 " * 20000}
    df = spark.createDataFrame([(k, f"Ended 2024 2025 {t}") for k, t in texts.items()], "k string, text string")
    began = time.perf_counter()
    rows = readers.text_run_rows(df, ["k"], "text").groupBy("k").count().collect()
    readers.dot_leader_rows(df, ["k"], "text").count(), readers.text_lines(df, ["k"], "text").count()
    assert time.perf_counter() - began < 40
    assert {r["k"]: r["count"] for r in rows}["figures"] == 5500


def test_text_runs(spark):
    from ledgerloom.operators import readers

    texts = [
        ("plain", "2024 2025 Net sales 5 (6) Costs 7 8 9 Rest of it — 1 Total — net 3 4"), ("short", "2024 2025 Sales 5 Costs 6 7"), ("marks", "x 2023 2024 2025 (a) Margin 1 % 2 % 3% Last - - -"), ("none", "Sales 1 2"), ("null", None), ("years only", "2024 2025 "),
    ]
    rows = readers.text_run_rows(spark.createDataFrame(texts, "k string, text string"), ["k"], "text")
    got = sorted((r.k, r.row, r.label, "|".join(r.figures)) for r in rows.collect())
    assert got == [
        ("marks", 0, "a) Margin", "1%|2%|3%"), ("marks", 1, "Last", "-|-|-"), ("plain", 0, "Net sales", "5|(6)"), ("plain", 1, "Costs", "7|8"), ("plain", 2, "Rest of it", "—|1"), ("plain", 3, "Total — net", "3|4"), ("short", 0, "Costs", "6|7"),
    ]


def test_listed_items_are_found_with_each_label_keyed_once(spark):
    """A plan that keys the items again for each of their comparisons takes ten times as long."""
    item = lambda key, label: F.struct(F.lit(key).alias("key"), label.alias("label"))
    names = spark.range(4000).select(F.concat(F.lit("revenue from hot plates "), "id").alias("n"))
    began = time.perf_counter()
    found = names.select(labels.listed_item(F.concat(F.lit("net "), "n"), F.array(item("k1", F.col("n")), item("k2", F.lit("other things"))))["key"].alias("key"), labels.combined_line(F.concat(F.lit("our "), "n"), F.col("n")).alias("combined"))
    assert [tuple(r) for r in found.distinct().collect()] == [("k1", False)]
    took = time.perf_counter() - began
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("nanometers") <= 24 and took < 60


def test_a_combined_line_without_a_label_is_none(spark):
    data = [(None, "Net sales"), ("Total net sales", None), ("Total net sales", "Net sales"), ("Costs and net sales", "Net sales"), ("our net sales", "Net sales"), ("Net sales", "Net sales")]
    df = spark.createDataFrame(data, "a string, b string")
    assert [r.c for r in df.select(labels.combined_line(F.col("a"), F.col("b")).alias("c")).collect()] == [False, False, True, True, False, False]
