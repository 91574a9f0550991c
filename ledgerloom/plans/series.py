"""Series over time: repeats, neighbours, eras, newest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fiscal
from ..operators import aggregates, joins, statements, windows
from .adapters import ORDERS_SQL, Registry, orders, segment_orders, segment_quarters, table

query = Registry()
QUERIES, SQL = query.queries, query.sql
DAILY = "d AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)"


def _daily(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count("*").cast("long").alias("n"))


@query(f"""WITH {ORDERS_SQL}, c AS (SELECT o_custkey, date_trunc('quarter', day) AS qd, count(*) AS n FROM o GROUP BY ALL)
SELECT o_custkey, CAST(qd AS DATE) AS quarter_start, coalesce(n = lag(n) OVER w AND date_diff('day', CAST(lag(qd) OVER w AS DATE), CAST(qd AS DATE)) <= 120, false) AS repeated FROM c WINDOW w AS (PARTITION BY o_custkey ORDER BY qd)""")
def lag_repeat(spark, sf_dir):
    c = orders(spark, sf_dir).groupBy("o_custkey", F.trunc("day", "quarter").alias("quarter_start")).agg(F.count("*").alias("n"))
    return c.select("o_custkey", "quarter_start", windows.repeats_previous(c, ["o_custkey"], "quarter_start", "n").alias("repeated"))


@query(f"""WITH {ORDERS_SQL}, c AS (SELECT segment, nation, date_trunc('quarter', day) AS qd, count(*) AS n FROM s GROUP BY ALL)
SELECT a.segment, a.nation, CAST(a.qd AS DATE) AS quarter_start, CAST(a.n AS BIGINT) AS n FROM c a JOIN c b ON a.segment = b.segment AND a.nation = b.nation AND abs(date_diff('day', CAST(b.qd AS DATE), CAST(a.qd AS DATE)) - 365) <= 12 AND a.n = b.n""")
def year_ago_repeat(spark, sf_dir):
    c = segment_orders(spark, sf_dir).groupBy("segment", "nation", F.trunc("day", "quarter").alias("quarter_start")).agg(F.count("*").alias("n"))
    before = c.select("segment", "nation", F.col("quarter_start").alias("before"), F.col("n").alias("n_before"))
    out = joins.within_days(c, before, ["segment", "nation"], "quarter_start", "before", 12, -365).where("n = n_before")
    return out.select("segment", "nation", "quarter_start", F.col("n").cast("long"))


@query(f"""WITH {DAILY}, x AS (SELECT event_type, day, n, lag(n) OVER w AS a, lead(n) OVER w AS b FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day))
SELECT event_type, day, n, coalesce(abs(a - b) <= 0.2 * greatest(a, b) AND abs(n - a) > 0.15 * a AND abs(n - b) > 0.15 * b, false) AS outlier FROM x""")
def outlier_neighbours(spark, sf_dir):
    flag = windows.contradicted_by_neighbours(["event_type"], ["day"], "n", 0.2, 0.15)
    return _daily(spark, sf_dir).select("event_type", "day", "n", flag.alias("outlier"))


@query(f"""WITH {ORDERS_SQL} SELECT o_custkey, o_orderkey, day, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, day DESC, o_orderkey) AS r FROM o) WHERE r = 1""")
def newest_per_key(spark, sf_dir):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return joins.newest_per_key(orders(spark, sf_dir), ["o_custkey"], [rank, F.desc("day"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey", "day", "o_orderstatus")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity) AS INTEGER) AS occurrence FROM lineitem""")
def occurrence_key(spark, sf_dir):
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")]
    return joins.occurrence(table(spark, sf_dir, "lineitem"), ["l_partkey"], order).select("l_orderkey", "l_linenumber", "l_partkey", "occurrence")


@query("""WITH x AS (SELECT user_id, event_id, ts, event_type, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 0 ELSE 1 END AS new FROM events),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM x)
SELECT user_id, CAST(island AS INTEGER) AS island, any_value(event_type) AS event_type, CAST(count(*) AS BIGINT) AS n FROM i GROUP BY user_id, island""")
def eras_islands(spark, sf_dir):
    runs = windows.islands(table(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")], "event_type")
    return runs.groupBy("user_id", "island").agg(F.first("event_type").alias("event_type"), F.count("*").cast("long").alias("n"))


@query(f"""WITH {ORDERS_SQL} SELECT nation, o_orderkey FROM (SELECT nation, o_orderkey, row_number() OVER (PARTITION BY nation ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS r FROM s) WHERE r <= 3""")
def capped_sample(spark, sf_dir):
    rows = segment_orders(spark, sf_dir).select("nation", "o_orderkey")
    return windows.capped(rows, "nation", [F.md5(F.col("o_orderkey").cast("string"))], 3)


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, CASE WHEN date_diff('day', lag(day) OVER w, day) <= 120 THEN CAST(lag(amount) OVER w AS DOUBLE) END AS before FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY day, o_orderkey)""")
def asof_previous(spark, sf_dir):
    rows = orders(spark, sf_dir).withColumn("value", F.col("amount").cast("double"))
    return joins.previous(rows, ["o_custkey"], "day", [F.col("day"), F.col("o_orderkey")], {"value": "before"}, 120).select("o_orderkey", "before")


@query("""WITH e AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL), c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click')
SELECT c.event_id, e.value AS asof_value FROM c ASOF LEFT JOIN e ON c.user_id = e.user_id AND c.ts >= e.ts""")
def asof_state(spark, sf_dir):
    """The last purchase before each click of a user."""
    e = table(spark, sf_dir, "events")
    bought = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    clicks = e.where("event_type = 'click'").select("user_id", "event_id", F.col("ts").alias("at"))
    return joins.as_of(clicks, bought, ["user_id"], "at", "ts", ["value"]).select("event_id", "asof_value")


@query(f"""WITH {ORDERS_SQL}, v AS (SELECT o_custkey, fiscal_year % 3 AS choice, sum(CASE WHEN o_orderpriority LIKE '1%' THEN 2 ELSE 1 END) AS votes, max(day) AS newest FROM o GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS k, lead(votes) OVER w AS nxt FROM v WINDOW w AS (PARTITION BY o_custkey ORDER BY votes DESC, newest DESC, choice))
SELECT o_custkey, choice, CAST(votes AS BIGINT) AS votes, CAST(votes - coalesce(nxt, 0) AS BIGINT) AS lead FROM r WHERE k = 1""")
def vote_offset(spark, sf_dir):
    rows = orders(spark, sf_dir).select("o_custkey", (F.col("fiscal_year") % 3).alias("choice"), F.when(F.col("o_orderpriority").startswith("1"), 2).otherwise(1).alias("weight"), "day")
    return aggregates.vote(rows, ["o_custkey"], "choice", "weight", "day")


@query("""WITH r AS (SELECT l_partkey, l_extendedprice / l_quantity / nullif(lag(l_extendedprice / l_quantity) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity), 0) AS ratio FROM lineitem)
SELECT l_partkey, round(median(ratio), 6) AS median_ratio FROM r WHERE ratio IS NOT NULL GROUP BY l_partkey""")
def median_ratio(spark, sf_dir):
    from pyspark.sql import Window

    price = F.col("l_extendedprice") / F.col("l_quantity")
    w = Window.partitionBy("l_partkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    r = table(spark, sf_dir, "lineitem").select("l_partkey", (price / F.nullif(F.lag(price).over(w), F.lit(0.0))).alias("ratio"))
    return r.where("ratio IS NOT NULL").groupBy("l_partkey").agg(F.round(F.median("ratio"), 6).alias("median_ratio"))


@query(f"""WITH {ORDERS_SQL} SELECT o_orderstatus, segment, CAST(count(*) AS BIGINT) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM s GROUP BY GROUPING SETS ((o_orderstatus, segment), (segment), ())""")
def grouping_sets_score(spark, sf_dir):
    s = segment_orders(spark, sf_dir)
    return s.groupingSets([[s.o_orderstatus, s.segment], [s.segment], []], "o_orderstatus", "segment").agg(F.count("*").cast("long").alias("n"), F.sum("amount").cast("double").alias("total"))


@query(f"""WITH {ORDERS_SQL}, m AS (SELECT DISTINCT o_custkey, date_trunc('quarter', day) AS qd FROM o), x AS (SELECT o_custkey, qd, lead(qd) OVER (PARTITION BY o_custkey ORDER BY qd) AS nxt FROM m)
SELECT o_custkey, CAST(qd + INTERVAL 3 MONTH AS DATE) AS missing FROM x WHERE nxt = qd + INTERVAL 6 MONTH""")
def reread_select(spark, sf_dir):
    """Quarters without an order between two quarters that have one."""
    q = orders(spark, sf_dir).select("o_custkey", F.trunc("day", "quarter").alias("qd"))
    return statements.missing_between(q, ["o_custkey"], "qd")


@query(f"""WITH {ORDERS_SQL}, d AS (SELECT DISTINCT day FROM o), f AS (SELECT day, 930 AS k, make_date(year(day), 9, 30) AS this FROM d UNION ALL SELECT day, 1231, make_date(year(day), 12, 31) FROM d),
e AS (SELECT day, k, CASE WHEN date_diff('day', day, this) < -10 THEN CAST(this + INTERVAL 1 YEAR AS DATE) WHEN date_diff('day', day, this) > 356 THEN CAST(this - INTERVAL 1 YEAR AS DATE) ELSE this END AS fin FROM f),
g AS (SELECT *, date_diff('day', CAST(fin - INTERVAL 1 YEAR AS DATE), day) AS dd, abs(date_diff('day', fin, day)) AS gap FROM e)
SELECT day, CASE WHEN k = 930 THEN '0930' ELSE '1231' END AS mmdd, CASE WHEN gap <= 10 OR dd BETWEEN 74 AND 122 OR dd BETWEEN 158 AND 206 OR dd BETWEEN 242 AND 290 THEN CAST(year(fin) AS INTEGER) END AS fiscal_year,
CASE WHEN gap <= 10 THEN 'Q4' WHEN dd BETWEEN 74 AND 122 THEN 'Q1' WHEN dd BETWEEN 158 AND 206 THEN 'Q2' WHEN dd BETWEEN 242 AND 290 THEN 'Q3' END AS fiscal_period FROM g""")
def fiscal_label(spark, sf_dir):
    days = orders(spark, sf_dir).select("day").distinct().withColumn("mmdd", F.explode(F.array(F.lit("0930"), F.lit("1231"))))
    x = fiscal.fiscal_label(F.col("day"), F.col("mmdd"))
    return days.select("day", "mmdd", x["fiscal_year"].alias("fiscal_year"), x["fiscal_period"].alias("fiscal_period"))


@query("""WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT day, '1231' AS mmdd, CAST(date_trunc('quarter', day - 4) AS DATE) - 1 AS quarter_end FROM d
UNION ALL SELECT day, '0131', CAST(date_trunc('quarter', (day - 4) - INTERVAL 1 MONTH) + INTERVAL 1 MONTH AS DATE) - 1 FROM d""")
def quarter_end_before(spark, sf_dir):
    """For every day of a shipment the fiscal quarter that ended five days before at least, of years that end in December and in January."""
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")).distinct().withColumn("mmdd", F.explode(F.array(F.lit("1231"), F.lit("0131"))))
    return days.select("day", "mmdd", fiscal.quarter_end_before(F.col("day"), F.col("mmdd")).alias("quarter_end"))


@query(f"""WITH {ORDERS_SQL}, l AS (SELECT l_orderkey, l_linenumber, l_partkey, date_diff('day', day, CAST(l_shipdate AS DATE)) AS d FROM lineitem JOIN o ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN d = 0 THEN 'instant' WHEN d BETWEEN 80 AND 100 THEN 'quarter' WHEN d BETWEEN 250 AND 290 THEN 'nine_months' WHEN d BETWEEN 330 AND 400 THEN 'year' WHEN d > 0 THEN 'ytd' END AS duration FROM l""")
def period_duration(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(orders(spark, sf_dir).select(F.col("o_orderkey").alias("l_orderkey"), "day"), "l_orderkey")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", fiscal.duration_class(F.col("day"), F.col("l_shipdate").cast("date")).alias("duration"))


@query(f"""WITH {ORDERS_SQL}, y AS (SELECT segment, fiscal_year, sum(value) AS total, count(*) AS n FROM q GROUP BY ALL), f AS (SELECT segment, fiscal_year, sum(amount) AS fy FROM s WHERE o_orderkey % 500 <> 0 GROUP BY ALL)
SELECT segment, fiscal_year, n = 4 AND abs(CAST(total AS DOUBLE) - CAST(fy AS DOUBLE)) <= 0.001 * abs(CAST(fy AS DOUBLE)) AS ties FROM y JOIN f USING (segment, fiscal_year)""")
def ties_quarters(spark, sf_dir):
    years = segment_orders(spark, sf_dir).where("o_orderkey % 500 <> 0").groupBy("segment", "fiscal_year").agg(F.sum("amount").cast("double").alias("fy"))
    sums = segment_quarters(spark, sf_dir).groupBy("segment", "fiscal_year").agg(F.sum("value").cast("double").alias("total"), F.count("*").alias("n"))
    return sums.join(years, ["segment", "fiscal_year"]).select("segment", "fiscal_year", ((F.col("n") == 4) & (F.abs(F.col("total") - F.col("fy")) <= 0.001 * F.abs("fy"))).alias("ties"))


@query(f"""WITH {ORDERS_SQL} SELECT o_orderkey, CAST(sum(amount) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS so_far FROM o""")
def running_subtotal(spark, sf_dir):
    return orders(spark, sf_dir).select("o_orderkey", windows.running(["o_custkey"], ["day", "o_orderkey"], "amount").cast("double").alias("so_far"))


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events""")
def fill_in_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return e.select("event_id", windows.filled(["user_id"], ["ts", "event_id"], "v").alias("filled"))
