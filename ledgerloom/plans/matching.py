"""Joins of values to values: by tolerance, by golden sets, by what is missing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, joins, selection, sets
from .adapters import ORDERS_SQL, Registry, money, orders, segment_orders, segment_quarters, table

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query(f"""WITH {ORDERS_SQL}, m AS (SELECT segment, nation, fiscal_year * 12 + month(day) AS m, CAST(sum(amount) AS DOUBLE) AS v FROM s GROUP BY ALL)
SELECT a.segment, a.nation, CAST(a.m AS INTEGER) AS month, a.v AS value, b.v AS next_value FROM m a JOIN m b ON a.segment = b.segment AND a.nation = b.nation AND b.m = a.m + 1 AND abs(a.v - b.v) <= 0.05 * a.v""")
def tolerance_join(spark, sf_dir):
    """Sums of neighbouring months within 5% of each other, by buckets of their logarithm."""
    m = segment_orders(spark, sf_dir).groupBy("segment", "nation", (F.col("fiscal_year") * 12 + F.month("day")).alias("month")).agg(F.sum("amount").cast("double").alias("value"))
    after = m.select("segment", "nation", (F.col("month") - 1).alias("month"), F.col("value").alias("next_value"))
    return joins.within_ratio(m, after, ["segment", "nation", "month"], "value", "next_value", 0.05).select("segment", "nation", "month", "value", "next_value")


@query(f"""WITH {ORDERS_SQL}, g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 40 = 0 THEN amount * 2 ELSE amount END AS golden FROM o ), c AS (SELECT o_orderkey, amount FROM o WHERE o_orderkey % 60 <> 20),
x AS (SELECT amount AS found, coalesce(abs(CAST(golden AS DOUBLE) - CAST(amount AS DOUBLE)) <= 0.005 * CAST(golden AS DOUBLE), false) AS ok FROM g LEFT JOIN c USING (o_orderkey))
SELECT CAST(count(*) FILTER (WHERE found IS NOT NULL AND ok) AS BIGINT) AS correct, CAST(count(*) FILTER (WHERE found IS NOT NULL AND NOT ok) AS BIGINT) AS wrong, CAST(count(*) FILTER (WHERE found IS NULL) AS BIGINT) AS missing,
round(count(*) FILTER (WHERE found IS NOT NULL AND ok) / count(*) FILTER (WHERE found IS NOT NULL), 6) AS accuracy, round(count(*) FILTER (WHERE found IS NOT NULL AND ok) / count(*), 6) AS recall FROM x""")
def golden_score(spark, sf_dir):
    o = orders(spark, sf_dir)
    golden = o.select("o_orderkey", F.when(F.col("o_orderkey") % 40 == 0, F.col("amount") * 2).otherwise(F.col("amount")).cast("double").alias("golden"))
    captured = o.where("o_orderkey % 60 <> 20").select("o_orderkey", F.col("amount").cast("double").alias("found"))
    both = golden.join(captured, "o_orderkey", "left")
    right = F.coalesce(F.abs(F.col("golden") - F.col("found")) <= 0.005 * F.col("golden"), F.lit(False))
    return aggregates.accuracy(both.withColumn("ok", right), "golden", "found", "ok")


@query("""SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def anti_inputs(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey").join(returned, "o_orderkey", "left_anti")


@query("""SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def semi_flagged(spark, sf_dir):
    flagged = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(flagged, "c_custkey", "left_semi")


@query("""WITH r AS (SELECT l_suppkey % 10 AS item, year(l_shipdate) * 4 + quarter(l_shipdate) AS q, max(l_quantity) AS v FROM lineitem GROUP BY ALL), f AS (SELECT l_linenumber AS tag, year(l_shipdate) * 4 + quarter(l_shipdate) AS q, max(l_quantity) AS v FROM lineitem GROUP BY ALL),
p AS (SELECT DISTINCT l_suppkey % 10 AS item, l_linenumber AS tag FROM lineitem)
SELECT item, tag, CAST(count(DISTINCT q) FILTER (WHERE r.v = f.v) AS BIGINT) AS quarters FROM p JOIN r USING (item) JOIN f USING (tag, q) GROUP BY item, tag HAVING count(*) FILTER (WHERE r.v <> f.v) = 0 AND count(DISTINCT q) >= 2""")
def learned_tag(spark, sf_dir):
    """Tags whose figures equal an item's in two quarters or more and differ in none."""
    li = table(spark, sf_dir, "lineitem").withColumn("q", F.year("l_shipdate") * 4 + F.quarter("l_shipdate"))
    read = li.groupBy((F.col("l_suppkey") % 10).alias("item"), "q").agg(F.max("l_quantity").alias("v"))
    fact = li.groupBy(F.col("l_linenumber").alias("tag"), "q").agg(F.max("l_quantity").alias("f"))
    pairs = li.select((F.col("l_suppkey") % 10).alias("item"), F.col("l_linenumber").alias("tag")).distinct()
    both = pairs.join(read, "item").join(fact, ["tag", "q"])
    agg = both.groupBy("item", "tag").agg(F.count_distinct("q").cast("long").alias("quarters"), F.bool_and(F.col("v") == F.col("f")).alias("same"))
    return agg.where("same AND quarters >= 2").select("item", "tag", "quarters")


@query(f"""WITH {ORDERS_SQL}, v AS (SELECT o_custkey, fiscal_year, o_orderstatus, CAST(round(sum(amount) / 100000) AS BIGINT) AS v, min(day) AS filed FROM o GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS n, first_value(v) OVER w AS won, first_value(filed) OVER w AS won_filed FROM v WINDOW w AS (PARTITION BY o_custkey, fiscal_year ORDER BY o_orderstatus))
SELECT o_custkey, fiscal_year, any_value(won) AS v, CASE WHEN count(*) = 1 THEN 'single' WHEN count(*) FILTER (WHERE n > 1 AND v = won) > 0 THEN 'confirmed' WHEN count(*) FILTER (WHERE n > 1 AND filed > won_filed) = 0 THEN 'restated' ELSE 'contradicted' END AS witness
FROM r GROUP BY o_custkey, fiscal_year""")
def witness_verdict(spark, sf_dir):
    """Each status is a presentation of a customer's year, the first in their order the one that counts."""
    v = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year", "o_orderstatus").agg(F.round(F.sum("amount") / 100000, 0).cast("long").alias("v"), F.min("day").alias("filed"))
    return selection.witnesses(v, ["o_custkey", "fiscal_year"], [F.col("o_orderstatus")], "v", "filed")


@query("""WITH l AS (SELECT l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_partkey % 7 <> 0) AS e, sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_partkey % 5 <> 0) AS t FROM lineitem GROUP BY ALL),
x AS (SELECT l_partkey, CAST(CASE WHEN l_partkey % 11 = 0 THEN -t WHEN l_partkey % 13 = 0 THEN t + 1 ELSE t END AS DOUBLE) AS later, CAST(e AS DOUBLE) AS earlier FROM l)
SELECT l_partkey, later, earlier, CASE WHEN earlier IS NULL THEN 'added' WHEN later IS NULL THEN 'removed' WHEN abs(later + earlier) <= 1e-6 * abs(later) THEN 'sign' ELSE 'changed' END AS change FROM x
WHERE (later IS NOT NULL OR earlier IS NOT NULL) AND NOT coalesce(abs(later - earlier) <= 1e-6 * abs(later), false)""")
def differences(spark, sf_dir):
    """Two vintages of part totals: some are dropped, some added, some restated, some of the other sign."""
    base = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum(money("l_extendedprice")).alias("v"))
    p = F.col("l_partkey")
    later = base.where(p % 5 != 0).select("l_partkey", F.when(p % 11 == 0, -F.col("v")).when(p % 13 == 0, F.col("v") + 1).otherwise(F.col("v")).cast("double").alias("v"))
    earlier = base.where(p % 7 != 0).select("l_partkey", F.col("v").cast("double").alias("v"))
    return selection.differences(later, earlier, ["l_partkey"], "v")


@query("""SELECT c_nationkey, CAST(sign(sum(sign(c_acctbal))) AS INTEGER) AS sign FROM customer GROUP BY c_nationkey""")
def sign_vote(spark, sf_dir):
    return selection.sign_vote(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_acctbal")


@query(f"""WITH {ORDERS_SQL} SELECT o_custkey, fiscal_year, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, fiscal_year ORDER BY CAST(amount < 450000 AS INTEGER) DESC, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, day DESC, o_orderkey DESC) AS r FROM o) WHERE r = 1""")
def choose_presentation(spark, sf_dir):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    out = selection.choose(orders(spark, sf_dir), ["o_custkey", "fiscal_year"], F.col("amount") < 450000, rank, [F.desc("day"), F.desc("o_orderkey")])
    return out.select("o_custkey", "fiscal_year", "o_orderkey")


_SPLITS = "p AS (SELECT p_partkey, make_date(1996 + p_partkey % 4, 6, 30) AS split_day, CAST(2 + p_partkey % 3 AS DOUBLE) AS ratio FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT p_partkey, make_date(2000, 1, 31), 1.5 FROM part WHERE p_partkey % 10 = 0)"


@query(f"""WITH {_SPLITS} SELECT l_orderkey, l_linenumber, l_partkey, coalesce((SELECT product(ratio) FROM p WHERE p_partkey = l_partkey AND split_day > CAST(l_shipdate AS DATE)), 1.0) AS factor FROM lineitem""")
def split_adjust(spark, sf_dir):
    """The product of all splits after a line's day, from a ledger of one or two splits for every fifth part."""
    part = table(spark, sf_dir, "part")
    one = part.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("l_partkey"), F.make_date(1996 + F.col("p_partkey").cast("int") % 4, F.lit(6), F.lit(30)).alias("split_day"), (2 + F.col("p_partkey") % 3).cast("double").alias("ratio"))
    two = part.where("p_partkey % 10 = 0").select(F.col("p_partkey").alias("l_partkey"), F.lit("2000-01-31").cast("date").alias("split_day"), F.lit(1.5).alias("ratio"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    return selection.split_factor(rows, one.union(two), "l_partkey", "day").select("l_orderkey", "l_linenumber", "l_partkey", "factor")


@query("""WITH b AS (SELECT l_partkey, year(l_shipdate) AS y, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS v FROM lineitem GROUP BY ALL),
y AS (SELECT l_partkey, y, v * CASE WHEN y >= 1998 AND l_partkey % 9 = 0 THEN 0.5 ELSE 1.0 END AS v FROM b),
r AS (SELECT l_partkey, y, lag(v) OVER (PARTITION BY l_partkey ORDER BY y) / v AS ratio FROM y)
SELECT l_partkey, CAST(y AS INTEGER) AS year, CAST(round(ratio) AS INTEGER) AS ratio FROM r WHERE round(ratio) >= 2 AND abs(ratio / round(ratio) - 1) <= 0.01""")
def split_ledger(spark, sf_dir):
    """Years whose average price falls to a whole part of the year before, within 1%."""
    from pyspark.sql import Window

    y = table(spark, sf_dir, "lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg((F.sum(money("l_extendedprice")).cast("double") / F.count("*")).alias("v"))
    y = y.withColumn("v", F.col("v") * F.when((F.col("year") >= 1998) & (F.col("l_partkey") % 9 == 0), 0.5).otherwise(1.0))
    r = y.withColumn("r", F.lag("v").over(Window.partitionBy("l_partkey").orderBy("year")) / F.col("v"))
    whole = F.round("r").cast("int")
    return r.where((whole >= 2) & (F.abs(F.col("r") / whole - 1) <= 0.01)).select("l_partkey", "year", whole.alias("ratio"))


@query(f"""WITH {ORDERS_SQL}, a AS (SELECT DISTINCT o_custkey, fiscal_year, o_orderpriority FROM o)
SELECT coalesce(x.o_custkey, y.o_custkey) AS o_custkey, coalesce(x.fiscal_year, y.fiscal_year + 1) AS fiscal_year, coalesce(x.o_orderpriority, y.o_orderpriority) AS line, CASE WHEN y.o_custkey IS NULL THEN 'added' ELSE 'removed' END AS change
FROM a x FULL JOIN a y ON x.o_custkey = y.o_custkey AND x.fiscal_year = y.fiscal_year + 1 AND x.o_orderpriority = y.o_orderpriority WHERE x.o_custkey IS NULL OR y.o_custkey IS NULL""")
def added_removed(spark, sf_dir):
    """Lines of each customer's year that the year before lacks, and the other way round."""
    o = orders(spark, sf_dir).select("o_custkey", "fiscal_year", F.col("o_orderpriority").alias("line"))
    return sets.added_removed(o, o.withColumn("fiscal_year", F.col("fiscal_year") + 1), ["o_custkey", "fiscal_year", "line"])


@query(f"""WITH {ORDERS_SQL}, k AS (SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS m FROM o GROUP BY ALL) SELECT m AS members, CAST(count(*) AS BIGINT) AS periods FROM k GROUP BY m""")
def same_key_set(spark, sf_dir):
    """How many customers list identical members."""
    return sets.key_sets(orders(spark, sf_dir), ["o_custkey"], "o_orderpriority").groupBy("members").agg(F.count("*").cast("long").alias("periods"))


@query(f"""WITH {ORDERS_SQL} SELECT segment, CAST(fiscal_year AS INTEGER) AS fiscal_year, fiscal_period, CAST(row_number() OVER (PARTITION BY segment ORDER BY fiscal_year DESC, fiscal_period DESC) AS INTEGER) AS recency FROM q QUALIFY recency <= 6""")
def newest_quarters(spark, sf_dir):
    """The newest six quarters of each series; a top-k report."""
    from pyspark.sql import Window

    w = Window.partitionBy("segment").orderBy(F.desc("fiscal_year"), F.desc("fiscal_period"))
    return segment_quarters(spark, sf_dir).select("segment", "fiscal_year", "fiscal_period", F.row_number().over(w).alias("recency")).where("recency <= 6")


def list_match(spark, sf_dir):
    """Greedy one-to-one matching of part names to longer labels that share two words or more; tested against a plain loop.

    Labels meet by pairs of their words, which are far rarer than single ones.
    """
    p = table(spark, sf_dir, "part")
    words = lambda c: F.array_sort(F.array_distinct(F.split(c, " ")))
    left = p.select(F.col("p_name").alias("a")).distinct().withColumn("x", words("a"))
    right = p.select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("b")).distinct().withColumn("y", words("b"))
    pairs = lambda c: F.explode(F.flatten(F.transform(c, lambda u: F.transform(F.filter(c, lambda v: v > u), lambda v: F.concat_ws(" ", u, v)))))
    met = left.select("a", "x", pairs(F.col("x")).alias("w")).join(right.select("b", "y", pairs(F.col("y")).alias("w")), "w")
    common = met.groupBy("a", "b").agg(F.first(F.size(F.array_intersect("x", "y"))).alias("n"))
    return joins.one_to_one(common, "a", "b", "n")


QUERIES["list_match"] = list_match
