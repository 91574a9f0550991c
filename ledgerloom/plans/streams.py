"""Real streams and sinks: files in, micro-batches with state, written tables out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import recording
from ..streaming import chains, runs
from .adapters import ORDERS_SQL, Registry, orders, table

query = Registry()
QUERIES, SQL = query.queries, query.sql

_KNOWN = "last_day(make_date(fiscal_year, 3 * CAST(substr(fiscal_period, 2) AS INT), 1))"


def late_readings(spark, sf_dir):
    """Each customer's revenue of each quarter in hundred thousands, known up to 700 days after the quarter: some after their successors."""
    rows = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year", "fiscal_period").agg(F.sum("amount").alias("v"))
    delay = F.expr("CAST((o_custkey * 7 + fiscal_year * 13 + CAST(substr(fiscal_period, 2) AS INT) * 129) % 700 AS INT)")
    return rows.select("o_custkey", "fiscal_period", "fiscal_year", F.round(F.col("v").cast("double") / 100000).alias("value"), F.date_add(F.expr(_KNOWN), delay).cast("timestamp").alias("available"))


_CHAIN_SQL = f"""WITH {ORDERS_SQL}, r AS (SELECT o_custkey, fiscal_period, fiscal_year, round(CAST(sum(amount) AS DOUBLE) / 100000) AS value FROM o GROUP BY ALL),
p AS (SELECT *, CASE WHEN lag(fiscal_year) OVER w = fiscal_year - 1 THEN lag(value) OVER w END AS reference FROM r WINDOW w AS (PARTITION BY o_custkey, fiscal_period ORDER BY fiscal_year))
SELECT o_custkey, fiscal_period, fiscal_year AS year, value, reference, CASE WHEN reference IS NULL THEN 'no reference' WHEN value = reference THEN 'repeats' ELSE 'read' END AS verdict FROM p"""


@query(_CHAIN_SQL)
def chained_quarters(spark, sf_dir):
    """A stream of readings in order of when they are known: keyed state, timers for missing years, revisions for late ones."""
    far = F.lit("2100-01-01").cast("timestamp")
    readings = late_readings(spark, sf_dir)
    ends = readings.sparkSession.createDataFrame([(-1,)], "o_custkey long").select("o_custkey", F.lit("Q0").alias("fiscal_period"), F.lit(0).alias("fiscal_year"), F.lit(0.0).alias("value"), far.alias("available"))
    at, files = runs.folder(spark, "readings"), spark.sparkContext.defaultParallelism
    known = readings.unionByName(ends)
    runs.in_batches(known, F.col("available"), [F.lit(x).cast("timestamp") for x in ("1993-06-01", "1995-01-01", "1996-06-01", "1998-01-01", "2090-01-01")], at, files)
    with chains.with_provider(spark, for_each_core=2):
        stream = runs.source(spark, at, known.schema, files).withWatermark("available", "10 days")
        verdicts = runs.to_end(chains.chained(stream, ["o_custkey"], "fiscal_period", "fiscal_year", "value", "available"), runs.folder(spark, "verdicts"), runs.folder(spark, "chain-state"))
    return chains.newest(verdicts.where("o_custkey <> -1"), ["o_custkey"], "fiscal_period").select("o_custkey", "fiscal_period", "year", "value", "reference", "verdict")


@query(_CHAIN_SQL)
def chained_quarters_batch(spark, sf_dir):
    """The same chains as one ordered run over the table."""
    out = chains.chained_batch(late_readings(spark, sf_dir), ["o_custkey"], "fiscal_period", "fiscal_year", "value", "available")
    return out.select("o_custkey", "fiscal_period", "year", "value", "reference", "verdict")


@query("""SELECT c.event_id, c.user_id, p.event_id AS purchase_id, p.value FROM (SELECT * FROM events WHERE event_type = 'click') c
LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 12 HOUR""")
def stream_attribution(spark, sf_dir):
    """Events, a fifth of them delivered twice, as a stream: repeats are dropped, clicks wait for purchases of the next 12 hours."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    sent = e.withColumn("sent", F.col("ts")).unionByName(e.where("event_id % 5 = 0").withColumn("sent", F.col("ts") + F.expr("interval 30 minutes")))
    ends = spark.createDataFrame([(-1, "click"), (-2, "purchase")], "event_id long, event_type string")
    far = F.lit("2100-01-01").cast("timestamp")
    sent = sent.unionByName(ends.select("event_id", far.alias("ts"), F.lit(-1).cast("long").alias("user_id"), "event_type", F.lit(0.0).alias("value"), far.alias("sent")))
    at, files = runs.folder(spark, "events"), spark.sparkContext.defaultParallelism
    runs.in_batches(sent, F.col("sent"), [F.lit(x).cast("timestamp") for x in ("2024-01-08", "2024-01-16", "2024-01-24", "2090-01-01")], at, files)
    once = lambda: runs.source(spark, at, sent.schema, files).withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"])
    clicks = once().where("event_type = 'click'").select("event_id", "user_id", "ts")
    purchases = once().where("event_type = 'purchase'").select(F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("bought"), "value")
    out = runs.to_end(runs.attributed(clicks, purchases, ["user_id"], "ts", "bought", "12 hours"), runs.folder(spark, "attributed"), runs.folder(spark, "attribution-state"))
    return out.where("event_id >= 0").select("event_id", "user_id", "purchase_id", "value")


_LINES_SQL = "l AS (SELECT o_custkey AS filing, o_orderstatus AS group_key, o_orderpriority AS line, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS value FROM orders GROUP BY ALL)"


@query(f"""WITH {_LINES_SQL}, again AS (SELECT c_custkey AS filing FROM customer WHERE c_nationkey % 2 = 0),
f AS (SELECT filing, group_key, line, value + 1 AS value FROM l WHERE filing IN (FROM again) AND line <> '5-LOW' AND group_key <> 'P')
SELECT l.filing, l.group_key, l.line, CAST(coalesce(f.value, l.value) AS DOUBLE) AS value, CASE WHEN f.filing IS NOT NULL OR l.filing NOT IN (FROM again) OR l.group_key = 'P' THEN 'verified' ELSE 'rejected' END AS status
FROM l LEFT JOIN f USING (filing, group_key, line)""")
def recorded_filings(spark, sf_dir):
    """Customers' lines are recorded as filings; those of every second nation are read again: figures differ, one line is gone, one group isn't read."""
    rows = orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("filing"), F.col("o_orderstatus").alias("group_key"), F.col("o_orderpriority").alias("line")).agg(F.sum("amount").cast("decimal(18,2)").alias("value"))
    rows = rows.withColumn("status", F.lit("verified"))
    at = runs.folder(spark, "recorded")
    recording.create(rows, at, "filing")
    filings = table(spark, sf_dir, "customer").where("c_nationkey % 2 = 0").select(F.col("c_custkey").alias("filing"))
    again = rows.join(filings, "filing", "left_semi").where("line <> '5-LOW' AND group_key <> 'P'").withColumn("value", (F.col("value") + 1).cast("decimal(18,2)"))
    recording.record(at, again, filings, ["filing", "group_key", "line"], "filing", filings.withColumn("group_key", F.lit("P")))
    return recording.read(spark, at).select("filing", "group_key", "line", F.col("value").cast("double"), "status")


@query(f"""WITH {ORDERS_SQL}, t AS (SELECT o_custkey AS filing, fiscal_year, CAST(sum(amount) AS DOUBLE) AS value, count(*) AS n FROM o GROUP BY ALL)
SELECT filing, fiscal_year, value, CASE WHEN value > 400000 AND n < 3 THEN 'needs_review' ELSE 'verified' END AS status, CASE WHEN value > 400000 AND n < 3 THEN 2 ELSE 1 END AS version FROM t""")
def held_release(spark, sf_dir):
    """One step flags large years, the next stands back those of several orders; only what ends different is written, once."""
    t = orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("filing"), "fiscal_year").agg(F.sum("amount").cast("double").alias("value"), F.count("*").alias("n"))
    at = runs.folder(spark, "held")
    recording.create(t.select("filing", "fiscal_year", "value", F.lit("verified").alias("status"), F.lit(1).alias("version")), at, "filing")
    held = recording.Held(spark, at, ["filing", "fiscal_year"], ["value", "status"], "filing")
    held.write(held.now().where("value > 400000").withColumn("status", F.lit("needs_review")))
    several = t.where("n >= 3").select("filing", "fiscal_year")
    held.write(held.now().where("status = 'needs_review'").join(several, ["filing", "fiscal_year"], "left_semi").withColumn("status", F.lit("verified")))
    held.release("version", 2)
    return recording.read(spark, at).select("filing", "fiscal_year", "value", "status", "version")
