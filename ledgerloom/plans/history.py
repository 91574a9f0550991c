"""Versions, merges, incremental reads and streams, over batch tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import store, windows
from ..streaming import ingest
from .adapters import Registry, table

query = Registry()
QUERIES, SQL = query.queries, query.sql


@query("""WITH v AS (SELECT user_id, event_type, ts, event_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS available_to FROM events)
SELECT user_id, event_type, event_id FROM v WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' AND (available_to IS NULL OR available_to > TIMESTAMP '2024-01-15 12:00:00')""")
def pit_asof(spark, sf_dir):
    """Events as versions of a user's state: the state at one point in time."""
    v = windows.intervals(table(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "ts")
    at = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return v.where((F.col("ts") <= at) & (F.col("available_to").isNull() | (F.col("available_to") > at))).select("user_id", "event_type", "event_id")


@query("""WITH s AS (SELECT event_id, event_type, value FROM events WHERE event_id % 3 <> 0), n AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'error' ELSE event_type END AS event_type, value + 1 AS value FROM events WHERE event_id % 2 = 0)
SELECT event_id, CASE WHEN s.event_id IS NULL THEN n.event_type WHEN n.event_id IS NULL OR s.event_type = 'purchase' THEN s.event_type WHEN n.event_type <> 'error' OR s.event_type = 'error' THEN n.event_type ELSE s.event_type END AS event_type,
CASE WHEN s.event_id IS NULL THEN n.value WHEN n.event_id IS NULL OR s.event_type = 'purchase' THEN s.value WHEN n.event_type <> 'error' OR s.event_type = 'error' THEN n.value ELSE s.value END AS value FROM s FULL JOIN n USING (event_id)""")
def upsert_rule(spark, sf_dir):
    """Purchases are locked; an error never replaces anything but an error."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    incoming = e.where("event_id % 2 = 0").select("event_id", F.when(F.col("event_id") % 4 == 0, "error").otherwise(F.col("event_type")).alias("event_type"), F.col("value") + 1)
    wins = (F.col("n.event_type") != "error") | (F.col("o.event_type") == "error")
    return store.upsert(e.where("event_id % 3 <> 0"), incoming.toDF("event_id", "event_type", "value"), ["event_id"], F.col("o.event_type") == "purchase", wins)


@query("""WITH b AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 1), a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 10 <> 2)
SELECT o_orderkey, CASE WHEN b.o_orderstatus IS NULL THEN 'added' WHEN a.o_orderstatus IS NULL THEN 'removed' ELSE 'changed' END AS change FROM b FULL JOIN a USING (o_orderkey) WHERE b.o_orderstatus IS DISTINCT FROM a.o_orderstatus""")
def served_changes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    after = o.where("o_orderkey % 10 <> 2").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return store.changes(o.where("o_orderkey % 10 <> 1"), after, ["o_orderkey"], ["o_orderstatus"])


@query("""SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents u WHERE u.doc_id = d.doc_id AND u.doc_id % 3 = 0 AND u.n_chars > 1000)""")
def units_incremental(spark, sf_dir):
    """Documents that have no complete unit of this reader's version."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    units = d.where("doc_id % 3 = 0").select("doc_id", (F.col("n_chars") > 1000).alias("complete"), F.lit("v2").alias("version"))
    return store.to_read(d.select("doc_id", "source"), units, ["doc_id"], "v2")


@query("""SELECT event_type, CAST(time_bucket(INTERVAL 1 DAY, ts) AS DATE) AS day, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL""")
def stream_window(spark, sf_dir):
    """The streaming query's tumbling windows, over the whole table as a batch."""
    e = table(spark, sf_dir, "events").withColumn("v", F.col("value").cast("decimal(18,2)"))
    out = ingest.windowed(e.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], "v")
    return out.select("event_type", F.col("window_start").cast("date").alias("day"), "n", F.col("total").cast("double"))


@query("""WITH x AS (SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM x) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, k""")
def stream_session(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.sessions(e, "ts", ["user_id"], "6 hours").select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


@query("""SELECT event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def last_wins(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    return store.last_wins(e, ["user_id", "day"], [F.desc("ts"), F.desc("event_id")]).select("event_id", "event_type", "value")
