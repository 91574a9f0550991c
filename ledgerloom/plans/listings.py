"""Lists of what customers order, by priority: which lines hold, go missing, are added, and how lists compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lists, statements
from .adapters import ORDERS_SQL, Registry, orders

query = Registry()
QUERIES, SQL = query.queries, query.sql

_W = f"{ORDERS_SQL}, w AS (SELECT o_custkey, o_orderpriority AS key, min(day) AS since, max(CASE WHEN o_custkey % 3 <> 0 THEN day END) AS until FROM o WHERE o_orderstatus = 'F' GROUP BY ALL)"


def _windows(spark, sf_dir):
    """Each customer's priorities as items, reported from the first finished order of theirs to the last; a third are open."""
    last = F.when(F.col("o_custkey") % 3 != 0, F.max("day"))
    return orders(spark, sf_dir).where("o_orderstatus = 'F'").groupBy("o_custkey", F.col("o_orderpriority").alias("key")).agg(F.min("day").alias("since"), last.alias("until"))


@query(f"""WITH {_W}, k AS (SELECT * FROM w WHERE DATE '1996-12-31' >= since - 10 AND (until IS NULL OR DATE '1996-12-31' <= until + 10))
SELECT o_custkey, key, CASE WHEN bool_or(key = '1-URGENT') OVER (PARTITION BY o_custkey) THEN '1-URGENT' END AS total FROM k""")
def lists_for_period(spark, sf_dir):
    items = _windows(spark, sf_dir).withColumn("total", F.lit("1-URGENT"))
    return lists.for_period(items, ["o_custkey"], F.lit("1996-12-31").cast("date"), "total").select("o_custkey", "key", "total")


@query(f"""WITH {_W} SELECT o_orderkey FROM o JOIN w ON o.o_custkey = w.o_custkey AND o_orderpriority = key WHERE o_orderstatus <> 'P' AND (day < since - 10 OR until IS NOT NULL AND day > until + 10)""")
def values_outside_windows(spark, sf_dir):
    values = orders(spark, sf_dir).select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("key"), "day", F.when(F.col("o_orderstatus") == "P", "rejected").otherwise("verified").alias("status"))
    return lists.outside_windows(values, _windows(spark, sf_dir), ["o_custkey", "key"], "day", "status").select("o_orderkey")


@query(f"""WITH {ORDERS_SQL} SELECT DISTINCT o_custkey, o_orderpriority AS key, 'not ordered since' AS reason FROM o a WHERE fiscal_year < 1996 AND NOT EXISTS (SELECT 1 FROM o b WHERE b.o_custkey = a.o_custkey AND b.o_orderpriority = a.o_orderpriority AND b.fiscal_year >= 1996)""")
def lines_left_out(spark, sf_dir):
    line = lambda where: orders(spark, sf_dir).where(where).select("o_custkey", F.col("o_orderpriority").alias("key")).distinct()
    return lists.left_out(line("fiscal_year < 1996"), line("fiscal_year >= 1996"), ["o_custkey", "key"], "not ordered since")


@query(f"""WITH {ORDERS_SQL}, a AS (SELECT o_custkey, o_orderpriority AS key, bool_or(fiscal_year < 1996) AS known FROM o GROUP BY ALL)
SELECT o_custkey, key, known FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY known DESC, key) AS r FROM a) WHERE r <= 3""")
def additions_limited(spark, sf_dir):
    """Up to three lines of each customer, those known before 1996 first; the limit is the feature."""
    a = orders(spark, sf_dir).groupBy("o_custkey", F.col("o_orderpriority").alias("key")).agg(F.bool_or(F.col("fiscal_year") < 1996).alias("known"))
    return lists.limited(a, ["o_custkey"], "known", [F.col("key")], 3)


@query(f"""WITH {ORDERS_SQL}, n AS (SELECT o_custkey, max(day) AS newest FROM o GROUP BY ALL)
SELECT DISTINCT a.o_custkey, a.o_orderpriority AS key FROM o a WHERE NOT EXISTS (SELECT 1 FROM o b JOIN n USING (o_custkey) WHERE b.o_custkey = a.o_custkey AND b.o_orderpriority = a.o_orderpriority AND b.day >= newest - (91 * 4 - 20))""")
def lines_long_absent(spark, sf_dir):
    """Priorities that a customer's newest four quarters don't have."""
    values = orders(spark, sf_dir).select("o_custkey", F.col("o_orderpriority").alias("key"), "day")
    return lists.long_absent(values.select("o_custkey", "key").distinct(), values, ["o_custkey"], "key", "day", 4)


@query(f"""WITH {ORDERS_SQL}, c AS (SELECT o_custkey, o_orderpriority AS k, bool_or(fiscal_year >= 1995) AS cur, bool_or(fiscal_year = 1996) AS fresh, bool_or(fiscal_year = 1997) AS tagged FROM o GROUP BY ALL),
z AS (SELECT o_custkey, count_if(cur) AS current, count_if(cur AND fresh) AS named, count_if(cur AND tagged AND NOT fresh) AS from_xbrl, count_if(fresh) AS kept, count_if(fresh) AS fresh FROM c GROUP BY ALL)
SELECT o_custkey, CAST(current AS BIGINT) AS current, CAST(named AS BIGINT) AS named, CAST(from_xbrl AS BIGINT) AS from_xbrl, CAST(kept AS BIGINT) AS kept, CAST(fresh AS BIGINT) AS fresh,
CASE WHEN current > 0 THEN round((named + from_xbrl) / current, 6) END AS recall, CASE WHEN fresh > 0 THEN round(kept / fresh, 6) END AS precision FROM z""")
def lists_scored(spark, sf_dir):
    """Each customer's priorities as an owner's list, those of 1996 as a fresh one in other spelling, those of 1997 as tagged."""
    o = orders(spark, sf_dir).select("o_custkey", F.col("o_orderpriority").alias("label"), "fiscal_year")
    owner = o.groupBy("o_custkey", "label").agg(F.bool_or(F.col("fiscal_year") >= 1995).alias("current"))
    of = lambda y, c: o.where(F.col("fiscal_year") == y).select("o_custkey", c.alias("label")).distinct()
    spelled = F.concat(F.lit("("), F.lower(F.replace("label", F.lit("-"), F.lit(" - "))), F.lit(")"))
    return lists.list_score(owner, of(1996, spelled), of(1997, F.col("label")), ["o_custkey"], "label")


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey FROM o WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 3 = 0 OR o_orderkey % 3 = 0 AND o_orderkey % 4 >= 2)""")
def filings_pending(spark, sf_dir):
    """Orders as filings: a third was read before, and is read again unless it finished or failed twice."""
    o = orders(spark, sf_dir)
    log = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "processed").otherwise("failed").alias("status"), (F.col("o_orderkey") % 4).cast("int").alias("attempts"))
    return lists.pending(o.select("o_orderkey"), log, ["o_orderkey"], ["processed"], 2)


@query(f"""WITH {ORDERS_SQL} SELECT o_custkey, fiscal_year, CAST(sum(amount) AS DOUBLE) AS value FROM o WHERE o_custkey % 4 <> 0 GROUP BY ALL""")
def consolidated_figures(spark, sf_dir):
    """Customers' years as facts with and without a status dimension; a quarter of them has parts only."""
    year = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year").agg(F.sum("amount").cast("double").alias("value")).where("o_custkey % 4 <> 0").withColumn("dims", F.create_map().cast("map<string,string>"))
    parts = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year", "o_orderstatus").agg(F.sum("amount").cast("double").alias("value")).withColumn("dims", F.create_map(F.lit("status"), "o_orderstatus")).drop("o_orderstatus")
    return statements.consolidated(year.unionByName(parts), ["o_custkey", "fiscal_year"]).select("o_custkey", "fiscal_year", "value")


@query(f"""WITH {ORDERS_SQL}, g AS (SELECT DISTINCT o_custkey, day, DATE '1997-06-30' - day AS gap FROM o WHERE DATE '1997-06-30' - day BETWEEN 357 AND 371) SELECT o_custkey AS filing, arg_min(day, {{g: abs(gap - 364), d: day}}) AS comparative FROM g GROUP BY ALL""")
def comparative_ends(spark, sf_dir):
    """Of each customer's order days the one a year before the end of June 1997."""
    facts = orders(spark, sf_dir).select(F.col("o_custkey").alias("filing"), F.col("day").alias("end"))
    return statements.year_ago_end(facts, F.lit("1997-06-30").cast("date")).withColumnRenamed("end", "comparative")
