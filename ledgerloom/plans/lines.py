"""Lines of statements: unpivoted columns, presented periods, headings, exact figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, statements, windows
from .adapters import ORDERS_SQL, Registry, orders, segment_orders, segment_quarters, table

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query(f"""WITH {ORDERS_SQL}, n AS (SELECT o_custkey, fiscal_year, count(*) AS n FROM o GROUP BY ALL) SELECT o_custkey, fiscal_year, CAST(n AS BIGINT) AS lines FROM (SELECT *, max(n) OVER (PARTITION BY o_custkey) AS most FROM n) WHERE n >= 2 AND n >= 0.5 * most""")
def presented_periods(spark, sf_dir):
    """Years with at least half the lines of a customer's fullest year, two at least."""
    return statements.presented_periods(orders(spark, sf_dir), ["o_custkey"], "fiscal_year")


@query(f"""WITH {ORDERS_SQL},  w AS (PIVOT (SELECT segment, fiscal_year, fiscal_period, CAST(value AS DOUBLE) AS value FROM q) ON fiscal_period IN ('Q1', 'Q2', 'Q3', 'Q4') USING sum(value))
SELECT segment, fiscal_year, period, value FROM (UNPIVOT w ON Q1, Q2, Q3, Q4 INTO NAME period VALUE value)""")
def unpivot_columns(spark, sf_dir):
    w = segment_quarters(spark, sf_dir).groupBy("segment", "fiscal_year").pivot("fiscal_period", ["Q1", "Q2", "Q3", "Q4"]).agg(F.sum("value").cast("double"))
    return w.unpivot(["segment", "fiscal_year"], ["Q1", "Q2", "Q3", "Q4"], "period", "value").where("value IS NOT NULL")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN l_linenumber END AS total FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, max(total) OVER (PARTITION BY l_orderkey) AS last_total FROM l) WHERE last_total IS NULL OR l_linenumber <= last_total""")
def through_grand_total(spark, sf_dir):
    """Lines up to the last line that is a total (here: returned), all where there is none."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    out = statements.through_total(rows, ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "R")
    return out.select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"""WITH {ORDERS_SQL}, e AS (SELECT o_custkey, fiscal_year, min(amount) AS exact FROM o GROUP BY ALL), r AS (SELECT o_custkey, fiscal_year, round(min(amount), -3) AS rounded FROM o GROUP BY ALL)
SELECT o_custkey, fiscal_year, CAST(rounded AS DOUBLE) AS rounded, CAST(CASE WHEN abs(exact - rounded) <= 500 AND exact <> rounded THEN exact ELSE rounded END AS DOUBLE) AS precise FROM e JOIN r USING (o_custkey, fiscal_year)""")
def precise_figure(spark, sf_dir):
    """A figure rounded to thousands takes the exact one that it is the rounding of."""
    e = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year").agg(F.min("amount").cast("double").alias("value"))
    r = e.select("o_custkey", "fiscal_year", F.round("value", -3).alias("value"), F.lit(500.0).alias("half"))
    found = statements.precise_figures(r, e.withColumn("half", F.lit(0.005)), ["o_custkey", "fiscal_year"], "value", "half")
    return r.join(found.select("o_custkey", "fiscal_year", "precise"), ["o_custkey", "fiscal_year"], "left").select("o_custkey", "fiscal_year", F.col("value").alias("rounded"), F.coalesce("precise", "value").alias("precise"))


@query(f"""WITH {ORDERS_SQL}, a AS (SELECT segment, nation, fiscal_year, count(*) AS n FROM s GROUP BY ALL), b AS (SELECT segment, nation, fiscal_year - 1 AS fiscal_year, count(*) AS n FROM s GROUP BY ALL)
SELECT segment, nation, fiscal_year, CAST(coalesce(a.n, 0) AS BIGINT) AS first_read, CAST(coalesce(b.n, 0) AS BIGINT) AS second_read, CASE WHEN a.n = b.n THEN 'agreed' ELSE 'review' END AS verdict FROM a FULL JOIN b USING (segment, nation, fiscal_year)""")
def two_reader_consensus(spark, sf_dir):
    """Two readings side by side, here each year's counts and the next one's: equal figures stand, the rest is for review."""
    s = segment_orders(spark, sf_dir)
    read = lambda back: s.groupBy("segment", "nation", (F.col("fiscal_year") - back).alias("fiscal_year")).agg(F.count("*").cast("long").alias("n"))
    both = statements.consensus(read(0), read(1), ["segment", "nation", "fiscal_year"], "n")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(f"{c}_read")
    return both.select("segment", "nation", "fiscal_year", zero("first"), zero("second"), "verdict")


@query("""SELECT l_partkey, l_suppkey, l_orderkey FROM (SELECT *, count(*) OVER (PARTITION BY l_partkey, l_suppkey, l_quantity) AS n, row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_quantity ORDER BY l_orderkey, l_linenumber, l_extendedprice) AS r FROM lineitem) WHERE n > 1 AND r > 1""")
def cell_copies(spark, sf_dir):
    """All but the first line of those that copy a cell (part, supplier and quantity)."""
    rows = joins.occurrence(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey", "l_quantity"], [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice")])
    return rows.where("occurrence > 1").select("l_partkey", "l_suppkey", "l_orderkey")


@query(f"""WITH {ORDERS_SQL}, e AS (SELECT DISTINCT fiscal_year, fiscal_period FROM o), k AS (SELECT nation, fiscal_year, fiscal_period FROM s WHERE o_orderpriority LIKE '1%' GROUP BY ALL)
SELECT n_nationkey AS nation, CAST(count(*) AS BIGINT) AS expected, CAST(count(k.nation) AS BIGINT) AS kept FROM nation CROSS JOIN e LEFT JOIN k ON k.nation = n_nationkey AND k.fiscal_year = e.fiscal_year AND k.fiscal_period = e.fiscal_period GROUP BY 1""")
def coverage_summary(spark, sf_dir):
    """Expected periods of each nation and those that have a figure."""
    o = segment_orders(spark, sf_dir)
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"))
    return statements.coverage(nations, o, o.where(F.col("o_orderpriority").startswith("1")), "nation", ["fiscal_year", "fiscal_period"])


@query(f"""WITH {ORDERS_SQL}, r AS (SELECT o_custkey, fiscal_year, CASE WHEN sum(amount) > 1000000 THEN 'kept' ELSE 'unproven' END AS st, CASE WHEN count(*) % 2 = 0 THEN 'same' ELSE 'differs' END AS other FROM o GROUP BY ALL)
SELECT st AS status, CAST(count(*) FILTER (WHERE other = 'same') AS BIGINT) AS same, CAST(count(*) FILTER (WHERE other = 'differs') AS BIGINT) AS differs FROM r GROUP BY st""")
def verdict_counts(spark, sf_dir):
    r = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year").agg(F.when(F.sum("amount") > 1000000, "kept").otherwise("unproven").alias("status"), F.when(F.count("*") % 2 == 0, "same").otherwise("differs").alias("other"))
    return r.groupBy("status").agg(*[F.count_if(F.col("other") == c).cast("long").alias(c) for c in ("same", "differs")])


@query(f"""WITH {ORDERS_SQL}, n AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM o GROUP BY ALL) SELECT o_orderpriority, o_orderstatus, CAST(n AS BIGINT) AS n FROM n ORDER BY n DESC, o_orderpriority, o_orderstatus LIMIT 12""")
def top_reasons(spark, sf_dir):
    """The twelve most common pairs; a top-k report."""
    n = orders(spark, sf_dir).groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").cast("long").alias("n"))
    return n.orderBy(F.desc("n"), "o_orderpriority", "o_orderstatus").limit(12)


@query("""SELECT o_orderkey FROM orders WHERE CAST(('0x' || md5(CAST(o_orderkey AS VARCHAR))[:8]) AS BIGINT) % 10 = 0""")
def spot_check(spark, sf_dir):
    """A deterministic sample of about one row in ten by hash; a sampling operator."""
    return windows.spot_checked(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
