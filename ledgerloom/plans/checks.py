"""Integrity checks over revenue, balances and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, checks
from .adapters import ORDERS_SQL, Registry, money, orders, segment_orders, segment_quarters, table

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query(f"""WITH {ORDERS_SQL}, p AS (SELECT segment, fiscal_year, sum(value) AS v FROM q WHERE segment <> 'FURNITURE' OR fiscal_year % 2 = 0 GROUP BY ALL),
a AS (SELECT fiscal_year, sum(v) AS parts_sum FROM p GROUP BY ALL), t AS (SELECT fiscal_year, sum(amount) AS total FROM s GROUP BY ALL)
SELECT fiscal_year, CAST(parts_sum AS DOUBLE) AS parts_sum, CAST(total AS DOUBLE) AS total, round(abs(CAST(parts_sum AS DOUBLE) - CAST(total AS DOUBLE)) / abs(CAST(total AS DOUBLE)), 9) AS error,
CASE WHEN abs(CAST(parts_sum AS DOUBLE) - CAST(total AS DOUBLE)) / abs(CAST(total AS DOUBLE)) > 0.01 THEN 'fail' ELSE 'pass' END AS result FROM t LEFT JOIN a USING (fiscal_year)""")
def parts_vs_total(spark, sf_dir):
    """In odd years one segment is missing, which the check has to find."""
    parts = segment_quarters(spark, sf_dir).where("segment <> 'FURNITURE' OR fiscal_year % 2 = 0")
    totals = segment_orders(spark, sf_dir).groupBy("fiscal_year").agg(F.sum("amount").alias("amount"))
    out = checks.parts_vs_total(parts, totals, ["fiscal_year"], "value", "amount")
    return out.select("fiscal_year", F.col("parts_sum").cast("double"), F.col("total").cast("double"), F.round("error", 9).alias("error"), "result")


@query(f"""WITH {ORDERS_SQL}, p AS (SELECT fiscal_year, o_orderpriority, CAST(sum(amount) AS DOUBLE) AS v FROM o GROUP BY ALL),
x AS (SELECT fiscal_year, round(100 * v / sum(v) OVER (PARTITION BY fiscal_year), 1) AS share FROM p)
SELECT fiscal_year, round(sum(share), 1) AS shares_sum, CASE WHEN bool_and(share BETWEEN 0 AND 100) AND abs(sum(share) - 100) <= 2.5 THEN 'pass' ELSE 'fail' END AS result FROM x GROUP BY fiscal_year""")
def mix_to_100(spark, sf_dir):
    from pyspark.sql import Window

    sums = orders(spark, sf_dir).groupBy("fiscal_year", "o_orderpriority").agg(F.sum("amount").cast("double").alias("v"))
    shares = sums.withColumn("share", F.round(100 * F.col("v") / F.sum("v").over(Window.partitionBy("fiscal_year")), 1))
    out = checks.mix_to_100(shares, ["fiscal_year"], "share")
    return out.select("fiscal_year", F.round("shares_sum", 1).alias("shares_sum"), "result")


@query(f"""WITH {ORDERS_SQL}, n AS (SELECT n_regionkey, nation, sum(amount) AS v FROM s JOIN nation ON nation = n_nationkey GROUP BY ALL),
c AS (SELECT n_regionkey, sum(v) AS parts_sum FROM n WHERE nation % 7 <> 3 GROUP BY ALL), t AS (SELECT n_regionkey, sum(v) AS total FROM n GROUP BY ALL)
SELECT n_regionkey, CAST(parts_sum AS DOUBLE) AS parts_sum, CAST(total AS DOUBLE) AS total, CASE WHEN abs(CAST(parts_sum AS DOUBLE) - CAST(total AS DOUBLE)) > 0.01 * abs(CAST(total AS DOUBLE)) THEN 'fail' ELSE 'pass' END AS result FROM t LEFT JOIN c USING (n_regionkey)""")
def lines_vs_parent(spark, sf_dir):
    """Nations are the lines under their region; some are left out."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_regionkey")
    lines = segment_orders(spark, sf_dir).groupBy("nation").agg(F.sum("amount").alias("v")).join(n, "nation")
    parents = lines.groupBy("n_regionkey").agg(F.sum("v").alias("t"))
    out = checks.parts_vs_total(lines.where("nation % 7 <> 3"), parents, ["n_regionkey"], "v", "t")
    return out.select("n_regionkey", F.col("parts_sum").cast("double"), F.col("total").cast("double"), "result")


@query("""WITH tree AS (SELECT 'r' || r_regionkey AS id, NULL AS parent, CAST(r_regionkey AS BIGINT) AS v FROM region WHERE r_regionkey % 2 = 0
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, CAST(n_nationkey AS BIGINT) FROM nation WHERE n_nationkey % 3 <> 0
UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey FROM customer)
SELECT t.id, t.parent, t.v FROM tree t LEFT JOIN tree p ON t.parent = p.id LEFT JOIN tree g ON g.id = 'r' || (SELECT n_regionkey FROM nation WHERE 'n' || n_nationkey = t.parent)
WHERE p.id IS NULL AND (t.id LIKE 'r%' OR t.id LIKE 'n%' OR t.id LIKE 'c%')""")
def top_level_rollup(spark, sf_dir):
    """Lines of a tree of regions, nations and customers that no ancestor covers; a missing parent ends a line."""
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    row = lambda p, k, up: (F.concat(F.lit(p), F.col(k)).alias("id"), up.alias("parent"), F.col(k).cast("long").alias("v"))
    tree = r.where("r_regionkey % 2 = 0").select(*row("r", "r_regionkey", F.lit(None).cast("string")))
    tree = tree.union(n.where("n_nationkey % 3 <> 0").select(*row("n", "n_nationkey", F.concat(F.lit("r"), "n_regionkey"))))
    tree = tree.union(c.select(*row("c", "c_custkey", F.concat(F.lit("n"), "c_nationkey"))))
    return aggregates.top_level(tree, "id", "parent")


@query("""SELECT l_partkey, l_suppkey, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS items FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_orderkey) > 1""")
def shared_cell(spark, sf_dir):
    return checks.shared_cells(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], "l_orderkey")


@query("""WITH n AS (SELECT l_orderkey, l_returnflag, count(*) AS c FROM lineitem GROUP BY ALL),
u AS (SELECT l_orderkey, l_returnflag AS usual_row FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY c DESC, l_returnflag) AS k FROM n) WHERE k = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, usual_row FROM lineitem JOIN u USING (l_orderkey) WHERE l_returnflag <> usual_row""")
def off_row(spark, sf_dir):
    found = checks.off_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"), ["l_orderkey"], "l_returnflag")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "usual_row")


@query(f"""WITH {ORDERS_SQL}, c AS (SELECT c_custkey, c_acctbal, coalesce(CAST(sum(amount) AS DOUBLE), 0) AS bought FROM customer LEFT JOIN o ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_custkey, CASE WHEN abs((c_acctbal + bought + c_custkey % 3) - (c_acctbal + bought)) > 1 THEN 'fail' ELSE 'pass' END AS result FROM c""")
def check_balance(spark, sf_dir):
    """Assets are balance and purchases with an error of c_custkey % 3, claims both without it."""
    bought = orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("amount").cast("double").alias("b"))
    c = table(spark, sf_dir, "customer").join(bought, "c_custkey", "left").withColumn("claims", F.col("c_acctbal") + F.coalesce("b", F.lit(0.0)))
    return c.select("c_custkey", checks.balances(F.col("claims") + F.col("c_custkey") % 3, F.col("claims"), F.lit(1.0)).alias("result"))


@query(f"""WITH {ORDERS_SQL}, m AS (SELECT o_custkey, fiscal_year, sum(amount) AS v FROM o GROUP BY ALL),
r AS (SELECT o_custkey, fiscal_year, v, sum(v) OVER w AS closing, coalesce(sum(v) OVER (PARTITION BY o_custkey ORDER BY fiscal_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS opening FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY fiscal_year))
SELECT o_custkey, fiscal_year, CASE WHEN abs(CAST(opening + v - closing AS DOUBLE) - CASE WHEN o_custkey % 5 = 0 THEN 100 ELSE 0 END) > 0.5 AND abs(CAST(opening + v - closing AS DOUBLE) - CASE WHEN o_custkey % 5 = 0 THEN 100 ELSE 0 END + CASE WHEN fiscal_year % 2 = 0 THEN 100 ELSE 0 END) > 0.5 THEN 'fail' ELSE 'pass' END AS result FROM r""")
def check_cash(spark, sf_dir):
    """Running totals roll from year to year; a planted 100 is explained by an effect in even years only."""
    from ..operators.windows import running

    years = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year").agg(F.sum("amount").alias("v"))
    rolled = years.withColumn("closing", running(["o_custkey"], ["fiscal_year"], "v"))
    off = F.when(F.col("o_custkey") % 5 == 0, 100.0).otherwise(0.0)
    effect = F.when(F.col("fiscal_year") % 2 == 0, F.lit(100.0))
    opening = (F.col("closing") - F.col("v")).cast("double")
    return rolled.select("o_custkey", "fiscal_year", checks.rolls(opening, F.col("v").cast("double"), F.col("closing").cast("double") + off, effect, F.lit(0.5)).alias("result"))


@query("""WITH f AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) FILTER (WHERE l_returnflag <> 'R') AS kept FROM lineitem GROUP BY ALL)
SELECT l_orderkey, round(CAST(gross - discount AS DOUBLE), 4) AS total, round(CAST(gross - kept AS DOUBLE), 4) AS computed, CASE WHEN kept IS NULL THEN 'none' WHEN abs(CAST(discount - kept AS DOUBLE)) > 0.5 THEN 'fail' ELSE 'pass' END AS result FROM f""")
def check_calc(spark, sf_dir):
    """Net is gross less discount by arcs; the discount tagged leaves out returned lines."""
    cut = money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")
    f = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).alias("gross"), F.sum(cut).alias("d"), F.sum(F.when(F.col("l_returnflag") != "R", cut)).alias("discount"))
    values = {"net": F.col("gross") - F.col("d"), "gross": F.col("gross"), "discount": F.col("discount")}
    facts = f.select("l_orderkey", F.explode(F.array(*[F.struct(F.lit(k).alias("concept"), v.cast("double").alias("value")) for k, v in values.items()])).alias("x")).select("l_orderkey", "x.*").where("value IS NOT NULL")
    arcs = spark.createDataFrame([("net", "gross", 1.0), ("net", "discount", -1.0)], "parent string, child string, weight double")
    out = checks.weighted_sum(F.broadcast(arcs), facts, ["l_orderkey"], 0.5)
    computed = F.when(F.col("result") != "none", F.round("computed", 4))
    return out.select("l_orderkey", F.round("total", 4).alias("total"), computed.alias("computed"), "result")


@query(f"""WITH {ORDERS_SQL}, n AS (SELECT n_regionkey, nation, o_custkey, sum(amount) AS v FROM s JOIN nation ON nation = n_nationkey GROUP BY ALL),
t AS (SELECT CAST(n_regionkey AS VARCHAR) AS code, sum(v) AS v FROM n GROUP BY ALL UNION ALL SELECT n_regionkey || '.' || nation, sum(v) + CASE WHEN nation % 4 = 0 THEN 10 ELSE 0 END FROM n GROUP BY n_regionkey, nation
UNION ALL SELECT n_regionkey || '.' || nation || '.' || o_custkey, sum(v) FROM n GROUP BY n_regionkey, nation, o_custkey),
c AS (SELECT regexp_extract(code, '^(.*)\\.[^.]+$', 1) AS code, sum(v) AS children FROM t GROUP BY 1)
SELECT t.code, CAST(t.v AS DOUBLE) AS total, CAST(c.children AS DOUBLE) AS children, CASE WHEN abs(t.v - c.children) > 0.5 THEN 'fail' ELSE 'pass' END AS result FROM t JOIN c ON t.code = c.code""")
def coded_tree(spark, sf_dir):
    """Codes region.nation.customer; nations divisible by four are 10 too high."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_regionkey")
    base = segment_orders(spark, sf_dir).groupBy("nation", "o_custkey").agg(F.sum("amount").alias("v")).join(n, "nation")
    level = lambda *c: base.groupBy(*c).agg(F.sum("v").alias("v")).withColumn("code", F.concat_ws(".", *c))
    nations = level("n_regionkey", "nation").withColumn("v", F.col("v") + F.when(F.col("nation") % 4 == 0, 10).otherwise(0))
    tree = level("n_regionkey").select("code", "v").union(nations.select("code", "v")).union(level("n_regionkey", "nation", "o_custkey").select("code", "v"))
    out = checks.coded_tree(tree, [], "code", "v", 0.5)
    return out.select("code", F.col("total").cast("double"), F.col("children").cast("double"), "result")


@query(f"""WITH {ORDERS_SQL}, v AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'mix' ELSE 'metric' END AS group_kind, CASE WHEN o_orderkey % 2 = 0 THEN 'ai' ELSE 'xbrl' END AS method, amount, day FROM o)
SELECT o_orderkey, 'large' AS "check" FROM v WHERE group_kind = 'metric' AND amount > 400000 UNION ALL SELECT o_orderkey, 'late' FROM v WHERE method = 'ai' AND day > DATE '2001-07-01' UNION ALL SELECT o_orderkey, 'round' FROM v WHERE amount % 1 = 0""")
def check_engine(spark, sf_dir):
    """Three named checks with their kinds and methods, in one pass."""
    kind, method = F.when(F.col("o_orderstatus") == "P", "mix").otherwise("metric"), F.when(F.col("o_orderkey") % 2 == 0, "ai").otherwise("xbrl")
    rows = orders(spark, sf_dir).select("o_orderkey", "amount", "day", kind.alias("group_kind"), method.alias("method"))
    named = [checks.Check("large", F.col("amount") > 400000, kinds=("metric",)), checks.Check("late", F.col("day") > "2001-07-01", methods=("ai",)), checks.Check("round", F.col("amount") % 1 == 0)]
    return checks.findings(rows, ["o_orderkey"], named)


@query(f"""WITH {ORDERS_SQL}, r AS (SELECT o_custkey, CASE WHEN amount > 490000 THEN 'fail' WHEN amount > 100000 THEN 'pass' ELSE 'none' END AS r FROM o)
SELECT o_custkey, CASE WHEN bool_or(r = 'fail') THEN 'rejected' WHEN bool_or(r = 'pass') THEN 'kept' ELSE 'unproven' END AS status FROM r GROUP BY o_custkey""")
def reading_status(spark, sf_dir):
    r = checks.outcome(F.col("amount") > 490000, F.col("amount") > 100000)
    agg = orders(spark, sf_dir).groupBy("o_custkey").agg(F.collect_set(r).alias("_r"))
    has = lambda v: F.when(F.array_contains("_r", v), v)
    return agg.select("o_custkey", checks.status([has("fail"), has("pass")]).alias("status"))


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, bool_or(amount > 495000) OVER (PARTITION BY o_custkey, fiscal_year) AS held FROM o""")
def validate_groups(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", checks.flag_group(["o_custkey", "fiscal_year"], F.col("amount") > 495000).alias("held"))
