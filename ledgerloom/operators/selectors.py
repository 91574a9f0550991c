"""Which filings, rows and tables are looked at again, and what a person gets to see of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import is_residual, label_key
from ..functions.numbers import parse_number
from .joins import newest_per_key


def same_identity(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("group_key", "kpi_key", "fiscal_year", "fiscal_period")) -> DataFrame:
    """Rows of two sets of values that speak of one figure, columns of the right side but its keys with `_right` behind their names."""
    renamed = right.select(*keys, *[F.col(c).alias(f"{c}_right") for c in right.columns if c not in keys])
    return left.join(renamed, list(keys))


def picked(values: DataFrame, rules: dict[str, Column], name: str, filing: str) -> DataFrame:
    """(filing): the filings of which a value fits the named rule."""
    return values.where(rules[name] & F.col(filing).isNotNull()).select(filing).distinct()


def beside_charts(values: DataFrame, keys: list[str], filing: str, share: Column) -> DataFrame:
    """(filing): other filings of periods whose figures shares read off a chart stand in for; rejected ones don't count."""
    held = values.where(share & (F.col("status") != "rejected")).select(*keys, F.col(filing).alias("_held")).distinct()
    return values.where(~share & F.col(filing).isNotNull()).join(held, keys).where(F.col(filing) != F.col("_held")).select(filing).distinct()


def of_segment_pages(rows: DataFrame, tables: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, tbl, row, segment): rows of a segment's table whose label the company's own tables print too, with other figures.

    rows: keys, tbl, row, label, value; tables: keys, tbl, segment (null for the company's own).
    """
    named = rows.join(tables, [*keys, "tbl"]).withColumn("_k", label_key(F.col("label"))).where("_k <> ''")
    own = named.where("segment IS NULL").groupBy(*keys, "_k").agg(F.collect_set("value").alias("_all"))
    both = named.where("segment IS NOT NULL").join(own, [*keys, "_k"])
    return both.where(~F.coalesce(F.array_contains("_all", F.col("value")), F.lit(False))).select(*keys, "tbl", "row", "segment")


def statement_others(readings: DataFrame, rows: DataFrame, keys: list[str], near: int = 6) -> DataFrame:
    """(keys, item, tbl, row): the income statement's own `Other` row for readings of a list's `Other` that came from another table.

    readings: keys, item, label, tbl, near_row (where the series' own row is); rows: keys, tbl, row, label, is_statement.
    """
    asks = readings.where(is_residual(F.col("label"))).join(rows.where("is_statement").select(*keys, "tbl").distinct(), [*keys, "tbl"], "left_anti")
    others = rows.where(F.col("is_statement") & is_residual(F.col("label"))).select(*keys, "tbl", "row")
    both = asks.select(*keys, "item", "near_row").join(others, keys).withColumn("_d", F.abs(F.col("row") - F.col("near_row"))).where(F.col("_d") <= near)
    return newest_per_key(both, [*keys, "item"], [F.col("_d"), F.col("tbl"), F.col("row")]).select(*keys, "item", "tbl", "row")


def audited_figures(items: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, item, flag) of accepted figures against their cells: no_locator, no_cell, differs; none for those that hold.

    items: keys, item, tbl, row, col, scale, value; cells: keys, tbl, row, col, text.
    """
    both = items.join(cells, [*keys, "tbl", "row", "col"], "left")
    printed = parse_number(F.col("text"))["value"] * F.coalesce("scale", F.lit(1.0))
    differs = ~F.coalesce(F.abs(printed - F.col("value")) <= 1e-9 * F.greatest(F.abs(printed), F.abs("value")), F.lit(False))
    flag = F.when(F.col("tbl").isNull(), "no_locator").when(F.col("text").isNull(), "no_cell").when(differs, "differs")
    return both.select(*keys, "item", flag.alias("flag")).where("flag IS NOT NULL")


def reading_patterns(values: DataFrame, fields: list[str]) -> DataFrame:
    """What each accepted reading proves: how it was found (tag, quote, table or other) and the fields that say where."""
    how = F.when(F.col("concept").isNotNull(), "tag").when(F.col("quote").isNotNull(), "quote").when(F.col("tbl").isNotNull(), "table").otherwise("other")
    return values.where("status = 'verified' AND method = 'ai'").select(*fields, how.alias("how"))


def by_size(members: DataFrame, keys: list[str], value: str, item: str) -> DataFrame:
    """(keys, items): a breakdown's members, the largest first, equal ones by name."""
    each = F.sort_array(F.collect_list(F.struct((-F.col(value)).alias("v"), F.col(item).alias("i"))))
    return members.groupBy(*keys).agg(F.transform(each, lambda x: x["i"]).alias("items"))


def predecessors(companies: DataFrame, known: dict[str, list[str]], symbol: str) -> DataFrame:
    """Companies with the registrants they go on from, by a fixed list; those without are left out."""
    pairs = F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return companies.select("*", F.explode(pairs[F.col(symbol)]).alias("predecessor"))


def json_lines(readings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, line): each reading as one line of JSON, fields in the table's order, those without a value left out."""
    return readings.select(*keys, F.to_json(F.struct("*")).alias("line"))


def batch_writes(batches: list[DataFrame], keys: list[str], fields: list[str]) -> DataFrame:
    """What several steps' writes come to when they are held and released together: the last of each key, and only if it differs from what was there.

    batches: the stored rows first, then each step's.
    """
    from functools import reduce

    numbered = [b.select(*keys, *fields, F.lit(i).alias("_b")) for i, b in enumerate(batches)]
    rows = reduce(DataFrame.unionByName, numbered)
    last = newest_per_key(rows, keys, [F.desc("_b")]).where("_b > 0")
    stored = numbered[0].select(*keys, F.struct(*fields).alias("_s"))
    return last.join(stored, keys, "left").where(F.col("_s").isNull() | ~F.col("_s").eqNullSafe(F.struct(*fields))).select(*keys, *fields)
