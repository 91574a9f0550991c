"""Readings scored, trees walked, statements flattened."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, selection, statements
from .adapters import ORDERS_SQL, Registry, orders, segment_orders, segment_quarters, table

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("""WITH l AS (SELECT l_returnflag, CAST(l_quantity AS BIGINT) AS q, count(*) AS n FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY ALL), r AS (SELECT l_returnflag, CAST(l_quantity AS BIGINT) AS q, count(*) AS n FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY ALL)
SELECT l_returnflag, CAST(sum(least(coalesce(l.n, 0), coalesce(r.n, 0))) AS BIGINT) AS matched, CAST(sum(greatest(coalesce(l.n, 0) - coalesce(r.n, 0), 0)) AS BIGINT) AS missing, CAST(sum(greatest(coalesce(r.n, 0) - coalesce(l.n, 0), 0)) AS BIGINT) AS extra FROM l FULL JOIN r USING (l_returnflag, q) GROUP BY l_returnflag""")
def multiset_score(spark, sf_dir):
    """Quantities on even lines against those on odd ones, as two readings of a page."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("long").alias("q"), "l_linenumber")
    return evaluate.multiset_difference(li.where("l_linenumber % 2 = 0"), li.where("l_linenumber % 2 = 1"), ["l_returnflag"], "q")


@query(f"""WITH {ORDERS_SQL}, x AS (SELECT CAST(amount AS DOUBLE) AS s, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(amount AS DOUBLE) WHEN 2 THEN round(CAST(amount AS DOUBLE), -3) ELSE CAST(amount AS DOUBLE) * 1.2 END AS f FROM o)
SELECT CASE WHEN f IS NULL THEN 'held' WHEN s = f THEN 'right' WHEN abs(s - f) <= 0.005 * abs(s) THEN 'rounded' ELSE 'wrong' END AS outcome, CAST(count(*) AS BIGINT) AS n FROM x GROUP BY 1""")
def code_reads(spark, sf_dir):
    k, s = F.col("o_orderkey") % 4, F.col("amount").cast("double")
    found = F.when(k == 1, s).when(k == 2, F.round(s, -3)).when(k == 3, s * 1.2)
    return orders(spark, sf_dir).groupBy(evaluate.read_class(s, found).alias("outcome")).agg(F.count("*").cast("long").alias("n"))


@query("""WITH r AS (SELECT p_brand AS g, p_name AS i FROM part WHERE p_size % 2 = 0 GROUP BY ALL), f AS (SELECT p_type AS g, p_name AS i FROM part WHERE p_size % 3 = 0 GROUP BY ALL), z AS (SELECT g, count(*) AS n FROM r GROUP BY g), c AS (SELECT r.g AS removed, f.g AS fresh, count(*) AS common FROM r JOIN f USING (i) GROUP BY ALL)
SELECT removed, fresh, CAST(common AS BIGINT) AS common FROM c JOIN z ON removed = z.g WHERE common >= 0.5 * n""")
def removed_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    removed = p.where("p_size % 2 = 0").select(F.col("p_brand").alias("g"), F.col("p_name").alias("i")).distinct()
    fresh = p.where("p_size % 3 = 0").select(F.col("p_type").alias("g"), F.col("p_name").alias("i")).distinct()
    return evaluate.come_back(removed, fresh, "g", "i")


@query("""WITH RECURSIVE e AS (SELECT 'r' || n_regionkey AS p, 'n' || n_nationkey AS c FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
w AS (SELECT p AS ancestor, c AS node, 1 AS depth FROM e UNION ALL SELECT w.ancestor, e.c, w.depth + 1 FROM w JOIN e ON w.node = e.p) SELECT ancestor, CAST(depth AS INTEGER) AS depth, CAST(count(*) AS BIGINT) AS nodes FROM w GROUP BY ALL""")
def member_descendants(spark, sf_dir):
    """How many nodes lie below each region and nation, by depth."""
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("r"), "n_regionkey").alias("p"), F.concat(F.lit("n"), "n_nationkey").alias("c"))
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("p"), F.concat(F.lit("c"), "c_custkey").alias("c"))
    return evaluate.descendants(n.union(c), "p", "c").groupBy("ancestor", "depth").agg(F.count("*").cast("long").alias("nodes"))


@query(f"""WITH {ORDERS_SQL}, c AS (SELECT o_custkey, fiscal_year, CAST(sum(amount) AS DOUBLE) AS v, max(day) AS d FROM o GROUP BY ALL)
SELECT a.o_custkey, a.fiscal_year, b.fiscal_year AS confirmed_by FROM c a JOIN c b ON a.o_custkey = b.o_custkey AND abs(date_diff('day', a.d, b.d) - 365) <= 12 WHERE abs(b.v - a.v) <= 0.5 * a.v""")
def next_year_confirmation(spark, sf_dir):
    """Yearly totals with a later one 365 days on, give or take 12, that is within half of it."""
    c = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year").agg(F.sum("amount").cast("double").alias("v"), F.max("day").alias("d"))
    found = statements.confirmed_next_year(c, ["o_custkey"], "d", "v", 0.5)
    at = c.select("o_custkey", "fiscal_year", "d")
    return found.join(at, ["o_custkey", "d"]).join(at.select("o_custkey", F.col("fiscal_year").alias("confirmed_by"), F.col("d").alias("later")), ["o_custkey", "later"]).select("o_custkey", "fiscal_year", "confirmed_by")


@query(f"""WITH {ORDERS_SQL}, w AS (SELECT segment, fiscal_year, sum(value) FILTER (WHERE fiscal_period = 'Q1') AS a, sum(value) FILTER (WHERE fiscal_period = 'Q2') AS b, sum(value) FILTER (WHERE fiscal_period = 'Q3') AS c, sum(value) FILTER (WHERE fiscal_period = 'Q4') AS d FROM q GROUP BY ALL)
SELECT segment, fiscal_year, true AS reaches, fiscal_year < 1990 AS misses FROM w WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND d IS NOT NULL""")
def income_chain(spark, sf_dir):
    """From the first quarter, plus or minus each other one: the end with one sign turned is reached, one off by 7 is not."""
    w = segment_quarters(spark, sf_dir).groupBy("segment", "fiscal_year").pivot("fiscal_period", ["Q1", "Q2", "Q3", "Q4"]).agg(F.sum("value").cast("double")).dropna()
    steps, end = F.array("Q2", "Q3", "Q4"), F.col("Q1") + F.col("Q2") - F.col("Q3") + F.col("Q4")
    return w.select("segment", "fiscal_year", evaluate.sign_chain(F.col("Q1"), steps, end).alias("reaches"), evaluate.sign_chain(F.col("Q1"), steps, end + 7).alias("misses"))


@query(f"""WITH {ORDERS_SQL} SELECT segment, fiscal_year, CAST(row_number() OVER (PARTITION BY segment, fiscal_year ORDER BY fiscal_period) - 1 AS INTEGER) AS line, fiscal_period AS concept, CAST(value AS DOUBLE) AS value FROM q""")
def flat_values(spark, sf_dir):
    """Statement periods as arrays of lines, then flattened again in their order."""
    rows = segment_quarters(spark, sf_dir).select("segment", "fiscal_year", F.col("fiscal_period").alias("concept"), F.col("value").cast("double").alias("value"), F.lit(False).alias("is_heading"))
    return statements.flat_lines(statements.gathered_lines(rows, ["segment", "fiscal_year"], "concept", ["concept", "value", "is_heading"]), ["segment", "fiscal_year"])


@query(f"""WITH {ORDERS_SQL}, c AS (SELECT nation, fiscal_year, list_sort(list(DISTINCT segment)) AS own FROM s GROUP BY ALL)
SELECT nation, fiscal_year, CAST(len(list_distinct(flatten(list(own) OVER (PARTITION BY nation ORDER BY fiscal_year RANGE BETWEEN CURRENT ROW AND 2 FOLLOWING)))) AS INTEGER) AS within_three FROM c""")
def sets_of_later_years(spark, sf_dir):
    """How many segments a nation names in a year and the two after it: a range frame over years."""
    from pyspark.sql import Window

    c = segment_orders(spark, sf_dir).groupBy("nation", "fiscal_year").agg(F.collect_set("segment").alias("own"))
    w = Window.partitionBy("nation").orderBy("fiscal_year").rangeBetween(0, 2)
    return c.select("nation", "fiscal_year", F.size(F.array_distinct(F.flatten(F.collect_list("own").over(w)))).alias("within_three"))


@query(f"""WITH {ORDERS_SQL}, v AS (SELECT o_custkey, fiscal_year, sum(amount) AS y, sum(amount) FILTER (WHERE fiscal_period <> 'Q4') AS n, sum(amount) FILTER (WHERE o_orderstatus <> 'P') AS y0, sum(amount) FILTER (WHERE fiscal_period <> 'Q4' AND o_orderstatus <> 'P') AS n0 FROM o GROUP BY ALL)
SELECT o_custkey, fiscal_year FROM v WHERE n IS NOT NULL AND (y IS DISTINCT FROM y0) <> (n IS DISTINCT FROM n0)""")
def mixed_vintage(spark, sf_dir):
    """Customers' years and nine months as first presented (without pending orders) and as presented later (with them)."""
    keys, nine = ["o_custkey", "fiscal_year"], F.col("fiscal_period") != "Q4"
    both = orders(spark, sf_dir).withColumn("period", F.explode(F.when(nine, F.array(F.lit("FY"), F.lit("9M"))).otherwise(F.array(F.lit("FY")))))
    read = both.groupBy(*keys, "period").agg(F.sum("amount").alias("later"), F.sum(F.when(F.col("o_orderstatus") != "P", F.col("amount"))).alias("first"))
    return selection.mixed_vintage(read.withColumn("restated", ~F.col("later").eqNullSafe(F.col("first"))), keys, "period", "restated")


@query("""WITH w AS (SELECT DISTINCT p_name AS a, p_name || ' ' || lower(p_type) AS b FROM part), l AS (SELECT a, b, list_distinct(string_split(a, ' ')) AS x, list_distinct(string_split(b, ' ')) AS y FROM w)
SELECT a, b, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 9) AS likeness FROM l""")
def label_likeness(spark, sf_dir):
    pairs = table(spark, sf_dir, "part").select(F.col("p_name").alias("a"), F.concat_ws(" ", "p_name", F.lower("p_type")).alias("b")).distinct()
    return pairs.select("a", "b", F.round(evaluate.likeness(F.col("a"), F.col("b")), 9).alias("likeness"))
