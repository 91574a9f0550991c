"""Derived periods, restated layouts, breakdowns of a cube."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import breakdowns, derive, identity
from ..operators.aggregates import most_common
from .adapters import ORDERS_SQL, Registry, orders, segment_orders, segment_quarters, table

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query(f"""WITH {ORDERS_SQL}, y AS (SELECT segment, fiscal_year, sum(value) AS fy, count(*) AS n, sum(value) FILTER (WHERE fiscal_period <> 'Q4') AS nine FROM q GROUP BY ALL)
SELECT segment, fiscal_year, 'Q4' AS fiscal_period, CAST(fy - nine AS DOUBLE) AS value, 'derived' AS method FROM y WHERE n = 4 AND fiscal_year % 2 = 0
UNION ALL SELECT segment, fiscal_year, 'FY', CAST(fy AS DOUBLE), 'derived' FROM y WHERE n = 4 AND fiscal_year % 2 = 1""")
def derive_periods(spark, sf_dir):
    """Even years are reported as a year and three quarters, odd ones as four quarters; the missing period is derived."""
    quarters = segment_quarters(spark, sf_dir)
    full = quarters.groupBy("segment", "fiscal_year").agg(F.sum("value").alias("value"), F.count("*").alias("n")).where("n = 4 AND fiscal_year % 2 = 0")
    reported = quarters.where("fiscal_year % 2 = 1 OR fiscal_period <> 'Q4'").union(full.select("segment", "fiscal_year", F.lit("FY"), "value"))
    keys = ["segment", "fiscal_year"]
    out = derive.missing_periods(derive.pivoted(reported, keys, "fiscal_period", "value"), keys)
    return out.select(*keys, "fiscal_period", F.col("value").cast("double"), "method")


@query(f"""WITH {ORDERS_SQL}, y AS (SELECT o_custkey, fiscal_year, sum(amount) AS fy, sum(amount) FILTER (WHERE fiscal_period <> 'Q4') AS nine, max(day) FILTER (WHERE fiscal_period <> 'Q4') AS d FROM o GROUP BY ALL)
SELECT o_custkey, fiscal_year, CAST(fy - nine AS DOUBLE) AS value FROM y WHERE nine IS NOT NULL AND date_diff('day', d, make_date(fiscal_year + 1, 1, 31)) <= 200 AND o_custkey % 4 <> 0""")
def fourth_quarter(spark, sf_dir):
    """A year filed on January 31 less nine months filed on their last order's day; every fourth line is per share."""
    rows = orders(spark, sf_dir)
    unit = F.when(F.col("o_custkey") % 4 == 0, "per_share").otherwise("currency").alias("unit")
    years = rows.groupBy("o_custkey", "fiscal_year").agg(F.sum("amount").alias("value")).select("*", unit, F.make_date(F.col("fiscal_year") + 1, F.lit(1), F.lit(31)).alias("filed"))
    nine = rows.where("fiscal_period <> 'Q4'").groupBy("o_custkey", "fiscal_year").agg(F.sum("amount").alias("value"), F.max("day").alias("filed"))
    return derive.fourth_quarter(years, nine, ["o_custkey", "fiscal_year"], "value").select("o_custkey", "fiscal_year", F.col("value").cast("double"))


@query(f"""WITH {ORDERS_SQL} SELECT segment, fiscal_year, CAST(sum(value) AS DOUBLE) AS nine_months FROM q WHERE fiscal_period IN ('Q1', 'Q2', 'Q3') GROUP BY ALL HAVING count(*) = 3""")
def derive_nine_months(spark, sf_dir):
    wide = derive.pivoted(segment_quarters(spark, sf_dir), ["segment", "fiscal_year"], "fiscal_period", "value")
    return wide.select("segment", "fiscal_year", (F.col("Q1") + F.col("Q2") + F.col("Q3")).cast("double").alias("nine_months")).where("nine_months IS NOT NULL")


@query(f"""WITH {ORDERS_SQL} SELECT segment, fiscal_year, fiscal_period, bool_and(value > 1000000) OVER (PARTITION BY segment, fiscal_year) AS published FROM q""")
def publish_whole(spark, sf_dir):
    return segment_quarters(spark, sf_dir).select("segment", "fiscal_year", "fiscal_period", derive.publishable(["segment", "fiscal_year"], F.col("value") > 1000000).alias("published"))


@query(f"""WITH {ORDERS_SQL}, a AS (SELECT fiscal_year, fiscal_period, 'segment' AS axis, segment AS member, sum(amount) AS v FROM s GROUP BY ALL
UNION ALL SELECT fiscal_year, fiscal_period, 'priority', o_orderpriority, sum(amount) FROM s GROUP BY ALL UNION ALL SELECT fiscal_year, fiscal_period, 'status', o_orderstatus, sum(amount) FROM s WHERE o_orderstatus <> 'P' GROUP BY ALL),
t AS (SELECT fiscal_year, fiscal_period, sum(amount) AS total FROM s GROUP BY ALL)
SELECT fiscal_year, fiscal_period, axis, CAST(count(*) AS BIGINT) AS members, CAST(sum(v) AS DOUBLE) AS parts, CAST(any_value(total) AS DOUBLE) AS total, abs(CAST(sum(v) AS DOUBLE) - CAST(any_value(total) AS DOUBLE)) <= 0.001 * abs(CAST(any_value(total) AS DOUBLE)) AS reconciles
FROM a JOIN t USING (fiscal_year, fiscal_period) GROUP BY ALL""")
def reconcile_cube(spark, sf_dir):
    """Facts with one axis each against the plain total; the status axis lacks a member."""
    keys = ["fiscal_year", "fiscal_period"]
    rows = segment_orders(spark, sf_dir)
    cube = [rows.groupBy(*keys, F.lit(a).alias("axis"), F.col(c).alias("member")) for a, c in (("segment", "segment"), ("priority", "o_orderpriority"), ("status", "o_orderstatus"))]
    from functools import reduce

    facts = reduce(lambda x, y: x.union(y), [g.agg(F.sum("amount").alias("value")) for g in cube]).where("axis <> 'status' OR member <> 'P'")
    facts = facts.select(*keys, F.map_from_arrays(F.array("axis"), F.array("member")).alias("dims"), "value")
    totals = rows.groupBy(*keys).agg(F.sum("amount").alias("value"))
    out = breakdowns.reconcile(breakdowns.single_axis(facts), totals, keys, "value")
    return out.select(*keys, "axis", "members", F.col("parts").cast("double"), F.col("total").cast("double"), "reconciles")


@query(f"""WITH {ORDERS_SQL}, t AS (SELECT fiscal_year, sum(amount) AS total, sum(amount) FILTER (WHERE o_orderkey % 100 = 7) AS lost FROM s GROUP BY ALL)
SELECT fiscal_year, CAST(lost AS DOUBLE) AS rest FROM t WHERE lost > 0 AND CAST(lost AS DOUBLE) / CAST(total AS DOUBLE) > 0.001 AND CAST(lost AS DOUBLE) / CAST(total AS DOUBLE) <= 0.02""")
def unallocated_gap(spark, sf_dir):
    """One order of a hundred is on no axis; two axes agree on what is missing."""
    rows = segment_orders(spark, sf_dir)
    totals = rows.groupBy("fiscal_year").agg(F.sum("amount").alias("value"))
    on = rows.where("o_orderkey % 100 <> 7")
    axis = lambda a, c: on.groupBy("fiscal_year", F.lit(a).alias("axis"), F.col(c).alias("member")).agg(F.sum("amount").alias("value"))
    out = breakdowns.reconcile(axis("segment", "segment").union(axis("status", "o_orderstatus")), totals, ["fiscal_year"], "value")
    return breakdowns.unallocated(out, ["fiscal_year"]).select("fiscal_year", F.col("rest").cast("double"))


@query("""WITH b AS (SELECT n_regionkey, n_nationkey, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i FROM b),
t AS (SELECT n_regionkey, sum(v) FILTER (WHERE i < 3) AS total, max(i) + 1 AS k FROM n GROUP BY ALL),
m AS (SELECT n_regionkey, total, unnest(generate_series(1, CAST(pow(2, k) AS BIGINT) - 1)) AS mask FROM t),
x AS (SELECT m.n_regionkey, mask, bit_count(mask) AS c, list(n_nationkey ORDER BY n_nationkey) AS items, sum(v) AS s, any_value(total) AS total FROM m JOIN n ON m.n_regionkey = n.n_regionkey AND (mask >> i) & 1 = 1 GROUP BY ALL)
SELECT n_regionkey, array_to_string(items, ',') AS items FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY c, mask) AS r FROM x WHERE c >= 2 AND abs(s - total) <= 5e-4 * abs(total)) WHERE r = 1""")
def subset_sum(spark, sf_dir):
    """The smallest set of a region's nations that gives the sum of its first three."""
    from pyspark.sql import Window

    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    sums = table(spark, sf_dir, "customer").join(n, "c_nationkey").groupBy("n_regionkey", "c_nationkey").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("v"))
    w = Window.partitionBy("n_regionkey").orderBy("c_nationkey")
    rows = sums.withColumn("i", F.row_number().over(w)).withColumn("total", F.sum(F.when(F.col("i") <= 3, F.col("v"))).over(Window.partitionBy("n_regionkey")))
    return breakdowns.subsets(rows, ["n_regionkey"], "c_nationkey", "v", "total").select("n_regionkey", F.array_join("items", ",").alias("items"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT a.l_partkey AS a, b.l_partkey AS b FROM lineitem a JOIN lineitem b ON a.l_suppkey = b.l_suppkey AND a.l_extendedprice = b.l_extendedprice AND a.l_partkey <> b.l_partkey),
w AS (SELECT a AS node, a AS reach FROM e UNION SELECT w.node, e.b FROM w JOIN e ON w.reach = e.a)
SELECT node, min(reach) AS series FROM w GROUP BY node""")
def identity_components(spark, sf_dir):
    """Parts that share a supplier's price point are one series."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_partkey").distinct()
    points = rows.groupBy("l_suppkey", "l_extendedprice").agg(F.min("l_partkey").alias("a"), F.collect_set("l_partkey").alias("_p"))
    # a price point's parts all hang on its lowest one: as many edges as parts, not as pairs
    edges = points.select("a", F.explode("_p").alias("b")).where("a <> b")
    return identity.series(edges)


@query("""WITH a AS (SELECT year(l_shipdate) AS y, l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS v, 'n' || (l_partkey % 97) || '_' || l_partkey AS later_name, 'p' || l_partkey AS earlier_name FROM lineitem GROUP BY ALL),
p AS (SELECT DISTINCT x.later_name, z.earlier_name FROM a x JOIN a z USING (y, v))
SELECT later_name, earlier_name FROM (SELECT *, count(*) OVER (PARTITION BY later_name) AS l, count(*) OVER (PARTITION BY earlier_name) AS e FROM p) WHERE l = 1 AND e = 1""")
def prior_equals(spark, sf_dir):
    """Lines that were renamed while their figures stayed: pairs that are unique on both sides."""
    v = table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("y"), "l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("v"))
    later = v.select("y", F.concat(F.lit("n"), F.col("l_partkey") % 97, F.lit("_"), "l_partkey").alias("name"), "v")
    return identity.renamed(later, v.select("y", F.concat(F.lit("p"), "l_partkey").alias("name"), "v"), ["y"], "name", "v")


@query("""WITH o AS (SELECT 'g' || (p_size % 5) AS g, p_partkey AS i, p_retailprice AS v FROM part), n AS (SELECT 'h' || (p_size % 5) || CASE WHEN p_size % 10 = 3 THEN 'x' ELSE '' END AS g, p_partkey AS i, p_retailprice + CASE WHEN p_size % 5 = 4 AND p_partkey % 50 = 0 THEN 1 ELSE 0 END AS v FROM part),
z AS (SELECT g, count(*) AS c FROM n GROUP BY g), m AS (SELECT n.g AS new_group, o.g AS old_group, count(*) AS common, bool_and(n.v = o.v) AS same FROM n JOIN o USING (i) GROUP BY ALL)
SELECT new_group, old_group, CAST(common AS BIGINT) AS common FROM (SELECT m.*, row_number() OVER (PARTITION BY new_group ORDER BY common DESC, old_group) AS r FROM m JOIN z ON new_group = z.g WHERE same AND common >= 0.5 * c) WHERE r = 1""")
def keep_groups(spark, sf_dir):
    """Renamed groups keep the key of the old group that half their items are from, unless a common figure differs."""
    p = table(spark, sf_dir, "part")
    old = p.select(F.concat(F.lit("g"), F.col("p_size") % 5).alias("g"), F.col("p_partkey").alias("i"), F.col("p_retailprice").alias("v"))
    name = F.concat(F.lit("h"), F.col("p_size") % 5, F.when(F.col("p_size") % 10 == 3, "x").otherwise(""))
    new = p.select(name.alias("g"), F.col("p_partkey").alias("i"), (F.col("p_retailprice") + F.when((F.col("p_size") % 5 == 4) & (F.col("p_partkey") % 50 == 0), 1).otherwise(0)).alias("v"))
    return identity.kept_group(new, old, "g", "i", "v")


@query(f"""WITH {ORDERS_SQL}, n AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM o GROUP BY ALL)
SELECT o_custkey, o_orderpriority, CAST(n AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS r FROM n) WHERE r = 1""")
def mode_currency(spark, sf_dir):
    return most_common(orders(spark, sf_dir), ["o_custkey"], "o_orderpriority")


@query(f"""WITH {ORDERS_SQL}, y AS (SELECT segment, fiscal_year, fiscal_period, value FROM q) SELECT a.segment, a.fiscal_year, a.fiscal_period, CAST(b.value - a.value AS DOUBLE) AS change FROM y a JOIN y b ON a.segment = b.segment AND a.fiscal_period = b.fiscal_period AND b.fiscal_year = a.fiscal_year + 1
WHERE (SELECT count(*) FROM y z WHERE z.segment = b.segment AND z.fiscal_year = b.fiscal_year) = 4""")
def adopt_restated(spark, sf_dir):
    """Quarters next to those of the next year's layout, where that year has all four."""
    q = segment_quarters(spark, sf_dir)
    whole = q.groupBy("segment", "fiscal_year").agg(F.count("*").alias("n")).where("n = 4").select("segment", "fiscal_year")
    later = q.join(whole, ["segment", "fiscal_year"], "left_semi").select("segment", (F.col("fiscal_year") - 1).alias("fiscal_year"), "fiscal_period", F.col("value").alias("later"))
    return q.join(later, ["segment", "fiscal_year", "fiscal_period"]).select("segment", "fiscal_year", "fiscal_period", (F.col("later") - F.col("value")).cast("double").alias("change"))
