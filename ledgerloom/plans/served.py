"""From pages to served lines: layout, statements, gate, choice and publication in one query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import let, statement_number
from ..operators import gates, layout, windows
from .adapters import Registry, dealt, orders

query = Registry()
QUERIES, SQL = query.queries, query.sql

#: Figures are printed in thousands with one decimal.
STEP = 100
RULES = [("total", "Total orders", 1), ("total", "Urgent orders", -1), ("total", "All other orders", -1)]


def pages(spark, sf_dir):
    """A statement of each customer's year as a page of placed boxes, and the next year's filing that prints it again: some restated, some with a misprint."""
    high = F.col("o_orderpriority") < "3"
    some = lambda where: F.coalesce(F.sum(F.when(where, F.col("amount"))).cast("double"), F.lit(0.0))
    years = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year").agg(some(high).alias("u"), some(~high).alias("r"), F.sum("amount").cast("double").alias("t"))
    each = dealt(years).withColumn("vintage", F.explode(F.array(F.lit(1), F.lit(2))))
    restated = F.when((F.col("vintage") == 2) & (F.col("o_custkey") % 3 == 0), 5000).otherwise(0)
    misprint = F.when((F.col("vintage") == 2) & (F.col("o_custkey") % 4 == 0), 9000).otherwise(0)
    printed = {"Urgent orders": F.col("u") + restated, "All other orders": F.col("r") + misprint, "Total orders": F.col("t") + restated}
    box = lambda left, top, text: F.concat(F.lit('<p style="position:absolute;left:'), left.cast("string"), F.lit(f"px;top:{top}px\">"), text, F.lit("</p>"))
    filed = F.make_date(F.col("fiscal_year") + F.col("vintage"), F.lit(2), F.lit(15))
    boxes = [box(F.lit(30), 20, F.concat(F.lit("Statement of customer "), F.col("o_custkey").cast("string"), F.lit(" for "), F.col("fiscal_year").cast("string"), F.lit(", filed "), filed.cast("string"))), box(F.lit(30), 40, F.lit("(in thousands)"))]
    for i, (label, value) in enumerate(printed.items()):
        text, share = F.format_number(F.round(value / STEP) * STEP / 1000, 1), F.concat(F.format_number(100 * value / F.col("t"), 1), F.lit("%"))
        flush = lambda edge, figure, top=100 + 18 * i: let(figure, lambda f: box(edge - 5 * F.length(f), top, f))
        boxes += [box(F.lit(30), 100 + 18 * i, F.lit(label)), flush(300, text), flush(400, share)]
    return each.select(F.concat_ws("-", "o_custkey", "fiscal_year", "vintage").alias("page"), F.concat(*boxes).alias("html"))


@query("""WITH v AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority < '3' AS h, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders),
c AS (SELECT o_custkey, y, coalesce(CAST(sum(v) FILTER (WHERE h) AS DOUBLE), 0) AS u, coalesce(CAST(sum(v) FILTER (WHERE NOT h) AS DOUBLE), 0) AS r, CAST(sum(v) AS DOUBLE) AS t FROM v GROUP BY ALL),
p AS (SELECT o_custkey, y, k, make_date(y + k, 2, 15) AS f, CASE WHEN k = 2 AND o_custkey % 3 = 0 THEN 5000 ELSE 0 END AS x, u, r, t FROM c, (VALUES (1), (2)) n(k) WHERE k = 1 OR o_custkey % 4 <> 0),
l AS (SELECT o_custkey, y, f, unnest(['Urgent orders', 'All other orders', 'Total orders']) AS line, unnest([u + x, r, t + x]) AS value FROM p),
d AS (SELECT *, 100 * round(value / 100) AS z FROM l), s AS (SELECT *, lag(z) OVER (PARTITION BY o_custkey, y, line ORDER BY f) AS b FROM d), e AS (SELECT * FROM s WHERE b IS NULL OR b <> z)
SELECT CAST(o_custkey AS VARCHAR) AS customer, y AS fiscal_year, line, z AS value, f AS available_from, lead(f) OVER (PARTITION BY o_custkey, y, line ORDER BY f) AS available_to FROM e""")
def pages_to_served(spark, sf_dir):
    """Pages are laid out, read as statements, held to their sums, and published: a version of each line from the filing that first gave it to the one that replaced it. Pages that don't add up change nothing."""
    parts = layout.read(layout.sectioned(layout.boxes(pages(spark, sf_dir), ["page"], "html"), ["page"]), ["page"])
    head = r"^Statement of customer ([0-9]+) for ([0-9]{4}), filed ([0-9-]{10})"
    is_text, text = lambda p: F.get(p, F.lit(0))["row"].isNull(), lambda p: F.get(F.get(p, F.lit(0))["cells"], F.lit(0))["text"]
    titles = F.transform(F.filter("parts", lambda p: is_text(p) & text(p).rlike(head)), text)
    read = parts.select(F.flatten(F.filter("parts", lambda p: ~is_text(p))).alias("rows"), F.explode_outer(titles).alias("title")).where("title IS NOT NULL")
    part = lambda i: F.regexp_extract("title", head, i)
    filed = read.select("rows", part(1).alias("customer"), part(2).cast("int").alias("fiscal_year"), part(3).cast("date").alias("available_from"), F.when(F.contains("title", F.lit("(in thousands)")), 1000.0).otherwise(1.0).alias("scale"))
    cell = lambda r, k: F.get(F.filter(r["cells"], lambda c: c["column"] == k), F.lit(0))["text"]
    line = lambda r: F.struct(cell(r, 0).alias("line"), F.round(statement_number(cell(r, 1), once=True) * F.col("scale"), 2).alias("value"), F.lit(STEP).alias("step"))
    printed = filed.select("customer", "fiscal_year", "available_from", F.transform("rows", line).alias("lines"))
    # a filing goes whole to where its year's others are; a filter before it would compute the lines once more for itself
    held = printed.select("customer", "fiscal_year", "available_from", F.when(gates.fits(F.col("lines"), RULES)["accepted"], F.col("lines")).alias("lines")).repartition("customer", "fiscal_year")
    keys = ["customer", "fiscal_year", "line"]
    told = held.select("customer", "fiscal_year", "available_from", F.explode_outer("lines").alias("_l")).where("_l IS NOT NULL").select(*keys[:2], "_l.line", "_l.value", "available_from")
    told = windows.islands(told, keys, [F.col("available_from")], "value", "_v").groupBy(*keys, "_v").agg(F.first("value").alias("value"), F.min("available_from").alias("available_from"))
    return windows.intervals(told, keys, [F.col("available_from")], "available_from").select(*keys, "value", "available_from", "available_to")
