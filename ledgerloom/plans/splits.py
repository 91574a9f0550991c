"""Breakdowns with overlaps, second splits and subtotals, and tables that arrive as running text, over orders."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import breakdowns, identity, readers
from .adapters import ORDERS_SQL, Registry, orders, segment_orders

query = Registry()
QUERIES, SQL = query.queries, query.sql

_NATIONS = f"{ORDERS_SQL}, m AS (SELECT nation, fiscal_year, segment AS item, sum(amount) AS v FROM s GROUP BY ALL), t AS (SELECT nation, fiscal_year, sum(v) AS t, count(*) AS n FROM m GROUP BY ALL)"


def _nation_segments(spark, sf_dir):
    """Members (segments' revenue) of each nation and year, beside their total; exact to cents."""
    m = segment_orders(spark, sf_dir).groupBy("nation", "fiscal_year", F.col("segment").alias("item")).agg(F.sum("amount").alias("v"))
    return m.withColumn("t", F.sum("v").over(Window.partitionBy("nation", "fiscal_year")))


@query(f"""WITH {_NATIONS}, e AS (SELECT nation, fiscal_year, 'overlap ' || o_orderpriority AS item, sum(amount) AS v FROM s WHERE o_orderpriority < '2' OR o_orderpriority >= '5' AND nation % 2 = 0 GROUP BY ALL),
g AS (SELECT * FROM m UNION ALL SELECT * FROM e), w AS (SELECT g.*, CAST(v AS DOUBLE) AS x, CAST(t AS DOUBLE) AS t, 0.001 * CAST(t AS DOUBLE) AS slack, CAST(sum(v) OVER p AS DOUBLE) - CAST(t AS DOUBLE) AS ex, count(*) OVER p AS k, row_number() OVER (PARTITION BY nation, fiscal_year ORDER BY item) AS r FROM g JOIN t USING (nation, fiscal_year) WINDOW p AS (PARTITION BY nation, fiscal_year)),
one AS (SELECT nation, fiscal_year, min(r) AS a, min(r) AS b FROM w WHERE abs(ex - x) <= slack AND k >= 3 AND abs(ex) > slack GROUP BY ALL),
two AS (SELECT l.nation, l.fiscal_year, min([l.r, h.r]) AS ab FROM w l JOIN w h ON l.nation = h.nation AND l.fiscal_year = h.fiscal_year AND l.r < h.r WHERE abs(l.ex - l.x - h.x) <= l.slack AND l.k >= 4 AND abs(l.ex) > l.slack GROUP BY ALL),
gone AS (SELECT * FROM one UNION ALL SELECT nation, fiscal_year, ab[1], ab[2] FROM two ANTI JOIN one USING (nation, fiscal_year))
SELECT w.nation, w.fiscal_year, w.item, w.x AS v FROM w LEFT JOIN gone USING (nation, fiscal_year) WHERE a IS NULL OR r NOT IN (a, b)""")
def overlaps_dropped(spark, sf_dir):
    """Segments of each nation's year, beside one or two order priorities that are part of them already."""
    keys = ["nation", "fiscal_year"]
    members = _nation_segments(spark, sf_dir)
    priority = F.col("o_orderpriority")
    extra = segment_orders(spark, sf_dir).where((priority < "2") | (priority >= "5") & (F.col("nation") % 2 == 0)).groupBy(*keys, F.concat(F.lit("overlap "), priority).alias("item")).agg(F.sum("amount").alias("v"))
    both = members.unionByName(extra.join(members.select(*keys, "t").distinct(), keys))
    return breakdowns.drop_overlaps(both, keys, "item", "v", "t")


@query(f"""WITH {_NATIONS}, h AS (SELECT nation, fiscal_year, item FROM t, (VALUES ('part one'), ('part two')) p(item))
SELECT nation, fiscal_year, item, true AS fine, n < 4 AS coarse FROM m JOIN t USING (nation, fiscal_year) WHERE n >= 4 UNION ALL
SELECT nation, fiscal_year, item, false, true FROM h JOIN t USING (nation, fiscal_year) WHERE n >= 4""")
def second_splits(spark, sf_dir):
    """Segments of each nation's year of four segments or more, beside a second complete split in two parts of 37 and 63 percent."""
    keys = ["nation", "fiscal_year"]
    members = _nation_segments(spark, sf_dir)
    whole = members.groupBy(*keys).agg(F.first("t").alias("t"), F.count("*").alias("n")).where("n >= 4").drop("n")
    first = F.round(F.col("t") * 0.37, 2).cast("decimal(18,2)")
    parts = F.array(F.struct(F.lit("part one").alias("item"), first.alias("v")), F.struct(F.lit("part two").alias("item"), (F.col("t") - first).cast("decimal(18,2)").alias("v")))
    halves = whole.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.*")
    rows = members.select(*keys, "item", F.col("v").cast("decimal(18,2)")).unionByName(halves).join(whole, keys)
    return breakdowns.two_partitions(rows, keys, "item", "v", "t", 1e-7)


@query(f"""WITH {_NATIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY nation, fiscal_year ORDER BY item) AS r FROM m JOIN t USING (nation, fiscal_year) WHERE n = 5)
SELECT nation, fiscal_year, item, CASE WHEN r <= 2 THEN 'sum of two' WHEN r = 3 THEN 'sum of three' ELSE 'whole' END AS parent FROM r UNION ALL SELECT DISTINCT nation, fiscal_year, 'sum of two', 'sum of three' FROM r UNION ALL SELECT DISTINCT nation, fiscal_year, 'sum of three', 'whole' FROM r""")
def subtotals_nested(spark, sf_dir):
    """Segments of each nation's year, beside a sum of the first two and one of the first three, and the sum of all, which is none."""
    keys = ["nation", "fiscal_year"]
    m = _nation_segments(spark, sf_dir).withColumns({"r": F.row_number().over(Window.partitionBy(*keys).orderBy("item")), "n": F.count("*").over(Window.partitionBy(*keys))}).where("n = 5")
    sums = [m.where(F.col("r") <= k).groupBy(*keys, F.lit(name).alias("item")).agg(F.sum("v").alias("v")).withColumn("leaf", F.lit(False)) for k, name in ((2, "sum of two"), (3, "sum of three"), (5, "sum of all"))]
    rows = m.select(*keys, "item", "v", F.lit(True).alias("leaf"))
    for x in sums:
        rows = rows.unionByName(x)
    return breakdowns.subtotal_tree(rows.withColumn("root", F.lit("whole")), keys, "item", "v", "leaf", "root", 1e-9)


@query(f"""WITH {ORDERS_SQL}, p AS (SELECT o_custkey, fiscal_year, fiscal_period, substr(o_orderpriority, 1, 1) AS i, CAST(sum(amount) AS DOUBLE) AS v FROM o GROUP BY ALL),
y AS (SELECT o_custkey, fiscal_year, count(DISTINCT i) AS n FROM p GROUP BY ALL), x AS (SELECT o_custkey, fiscal_year, i, row_number() OVER (PARTITION BY o_custkey, fiscal_year ORDER BY i) AS r FROM (SELECT DISTINCT o_custkey, fiscal_year, i FROM p))
SELECT o_custkey, fiscal_year, a.i AS item, b.i AS true_item FROM x a JOIN x b USING (o_custkey, fiscal_year) JOIN y USING (o_custkey, fiscal_year) WHERE n >= 2 AND b.r = a.r % n + 1""")
def renamed_items(spark, sf_dir):
    """Each customer's year by priority, whose items were stored under the name of the next one; a later filing restates them by their own."""
    keys = ["o_custkey", "fiscal_year"]
    item = F.substring("o_orderpriority", 1, 1)
    true = orders(spark, sf_dir).groupBy(*keys, item.alias("item")).agg(F.sum("amount").cast("double").alias("value")).withColumn("period", F.lit("Q1"))
    w = Window.partitionBy(*keys).orderBy("item")
    before = F.coalesce(F.lag("item").over(w), F.last("item").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    stored = true.withColumn("item", before)
    annual = true.groupBy(*keys, "item").agg(F.sum("value").alias("value"))
    return identity.relabelled(stored, true, annual, keys, "period", "item", "value")


@query("""WITH v AS (SELECT o_custkey, substr(o_orderpriority, 3) AS label, year(o_orderdate) AS y, CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS v FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997 GROUP BY ALL),
t AS (SELECT o_custkey, label, coalesce(format('{:,}', max(v) FILTER (WHERE y = 1995)), '—') AS a, coalesce(format('{:,}', max(v) FILTER (WHERE y = 1996)), '—') AS b, coalesce(format('({:,})', max(v) FILTER (WHERE y = 1997)), '—') AS c FROM v GROUP BY ALL)
SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY label) - 1 AS INTEGER) AS "row", 'Orders of ' || label AS label, a || '|' || b || '|' || c AS figures FROM t""")
def running_tables(spark, sf_dir):
    """Each customer's three years by priority as running text behind a caption and a row of years, read back."""
    o = orders(spark, sf_dir).where("fiscal_year BETWEEN 1995 AND 1997").groupBy("o_custkey", F.substring("o_orderpriority", 3, 20).alias("label")).pivot("fiscal_year", [1995, 1996, 1997]).agg(F.floor(F.sum("amount")))
    text = lambda y, form: F.when(F.col(str(y)).isNotNull(), F.format_string(form, F.col(str(y)).cast("long"))).otherwise("—")
    row = F.concat_ws(" ", F.lit("Orders of"), "label", text(1995, "%,d"), text(1996, "%,d"), text(1997, "(%,d)"))
    texts = o.groupBy("o_custkey").agg(F.concat(F.lit("(in full, 12 months) Ended 1995 1996 1997 "), F.array_join(F.sort_array(F.collect_list(row)), " "), F.lit(" see the notes")).alias("text"))
    return readers.text_run_rows(texts, ["o_custkey"], "text").select("o_custkey", "row", "label", F.array_join("figures", "|").alias("figures"))
