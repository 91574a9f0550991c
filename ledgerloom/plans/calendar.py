"""Fiscal calendars and dates in texts, over the orders' days."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fiscal
from .adapters import Registry, table

query = Registry()
QUERIES, SQL = query.queries, query.sql

#: Year ends that customers have in turn: all at the end of a month.
YEAR_ENDS = ("1231", "0930", "0630", "0131")
_D = "d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(o_custkey % 4 AS INTEGER) AS c, [12, 9, 6, 1][o_custkey % 4 + 1] AS m FROM orders)"
#: All quarter ends of a day's neighbouring years, the fiscal year of each and its number.
_Q = f"""{_D}, q AS (SELECT day, c, m, last_day(make_date(year(day) + y, m, 1) - to_months(3 * (4 - k))) AS e, year(day) + y AS fy, k FROM d, (VALUES (-1), (0), (1)) a(y), (VALUES (1), (2), (3), (4)) b(k))"""


def _days(spark, sf_dir):
    c = (F.col("o_custkey") % 4).cast("int")
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"), c.alias("c")).distinct().withColumn("mmdd", F.get(F.array(*map(F.lit, YEAR_ENDS)), F.col("c")))


@query(f"""WITH {_Q}, e AS (SELECT *, last_day(make_date(year(day), m, 1)) AS e0 FROM d),
y AS (SELECT day, c, m, CASE WHEN day - e0 > 10 THEN last_day(make_date(year(day) + 1, m, 1)) WHEN e0 - day > 356 THEN last_day(make_date(year(day) - 1, m, 1)) ELSE e0 END AS closing FROM e),
n AS (SELECT *, abs(closing - day) <= 10 AS closes, day - last_day(make_date(year(closing) - 1, m, 1)) AS n FROM y),
l AS (SELECT *, CASE WHEN closes THEN 'Q4' WHEN n BETWEEN 74 AND 122 THEN 'Q1' WHEN n BETWEEN 158 AND 206 THEN 'Q2' WHEN n BETWEEN 242 AND 290 THEN 'Q3' END AS fiscal_period FROM n)
SELECT day, c, closing, CASE WHEN fiscal_period IS NOT NULL THEN CAST(year(closing) AS INTEGER) END AS fiscal_year, fiscal_period, CASE WHEN closes THEN year(closing) END AS annual,
(SELECT max(e) FROM q WHERE q.day = l.day AND q.c = l.c AND e <= l.day - 5) AS before FROM l""")
def fiscal_days(spark, sf_dir):
    """Every order day on four calendars: the year that holds it, its label as a quarter's and a year's end, and the quarter a filing of that day reports."""
    day, mmdd = F.col("day"), F.col("mmdd")
    label, annual = fiscal.fiscal_label(day, mmdd), fiscal.fiscal_label(day, mmdd, True)
    return _days(spark, sf_dir).select(
        "day", "c", fiscal.fiscal_year_end_for(day, mmdd).alias("closing"), label["fiscal_year"].alias("fiscal_year"), label["fiscal_period"].alias("fiscal_period"), annual["fiscal_year"].cast("long").alias("annual"),
        fiscal.quarter_end_before(day, mmdd).alias("before"),
    )


@query(f"""WITH {_Q}, b AS (SELECT day, c, max(e) FILTER (WHERE e <= day - 5) AS usual, max(e) FILTER (WHERE e <= day) AS latest FROM q GROUP BY ALL)
SELECT day, c, CASE WHEN day - usual <= 75 THEN usual ELSE greatest(usual, latest) END AS reported, CASE WHEN c = 1 THEN usual - 3 ELSE usual END AS own, CASE WHEN c = 2 THEN '0930' ELSE ['1231', '0930', '0630', '0131'][c + 1] END AS year_end FROM b""")
def release_days(spark, sf_dir):
    """The quarter a release of each order day reports, by the calendar and by a company's own quarter ends three days earlier; a year end that an annual report has changed."""
    day, mmdd, c = F.col("day"), F.col("mmdd"), F.col("c")
    usual = fiscal.quarter_end_before(day, mmdd)
    own = fiscal.own_end(usual, F.when(c == 1, F.array(F.date_sub(usual, 3), F.date_sub(usual, 200))).otherwise(F.array().cast("array<date>")))
    annual = F.when(c == 2, F.array(F.to_date(F.concat(F.year(F.add_months(day, 3)), F.lit("-09-30"))))).otherwise(F.array(F.date_add(fiscal.year_end(F.year(day) + 1, mmdd), 4)))
    at = fiscal.year_end_at(day, F.transform(annual, lambda e: F.when(e >= day, e).otherwise(F.add_months(e, 12))), mmdd)
    return _days(spark, sf_dir).select("day", "c", fiscal.release_period(day, mmdd).alias("reported"), own.alias("own"), at.alias("year_end"))


@query(f"""WITH {_Q}, s AS (SELECT DISTINCT e, c, m, fy, k, n FROM q, (VALUES (0), (3), (6), (9), (12), (5)) t(n) WHERE abs(e - day) < 40)
SELECT e AS period_end, c, CAST(n AS INTEGER) AS months, CAST(CASE WHEN n = 5 OR n IN (6, 9) AND k NOT IN (2, 3) OR n = 12 AND k <> 4 THEN NULL ELSE fy END AS INTEGER) AS fiscal_year,
CASE WHEN n = 5 OR n IN (6, 9) AND k NOT IN (2, 3) OR n = 12 AND k <> 4 THEN NULL WHEN k = 4 AND n IN (0, 12) THEN 'FY' ELSE 'Q' || k END AS fiscal_period,
CASE WHEN n = 5 OR n IN (6, 9) AND k NOT IN (2, 3) OR n = 12 AND k <> 4 THEN NULL WHEN n = 0 THEN 'instant' WHEN n = 3 THEN 'quarter' WHEN n = 12 THEN 'year' ELSE 'ytd' END AS duration FROM s""")
def statement_periods(spark, sf_dir):
    """Columns that end with each quarter near an order day: balances, three to twelve months, and five, which no statement has."""
    ends = F.flatten(F.array(*[fiscal.nominal_quarter_ends(F.year("day") + k, F.col("mmdd")) for k in (-1, 0, 1)]))
    each = _days(spark, sf_dir).select("c", "mmdd", "day", F.explode(ends).alias("period_end")).where(F.abs(F.date_diff("period_end", "day")) < 40).select("c", "mmdd", "period_end").distinct()
    each = each.withColumn("months", F.explode(F.array(*map(F.lit, (0, 3, 6, 9, 12, 5)))))
    start = F.when(F.col("months") > 0, F.date_add(F.last_day(F.expr("add_months(trunc(period_end, 'month'), -months)")), 1))
    label = fiscal.label_period(start, F.col("period_end"), F.col("mmdd"))
    return each.select("period_end", "c", "months", *[label[f].alias(f) for f in ("fiscal_year", "fiscal_period", "duration")])


@query("""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT day, day AS slashed, day AS dotted, day(day) > 12 AS days_first, last_day(make_date(year(day), 3 * quarter(day), 1)) AS quarter, last_day(make_date(year(day), 3 * quarter(day), 1)) AS spelled, last_day(make_date(year(day), 6, 1)) AS half, CAST(6 AS INTEGER) AS half_months,
last_day(make_date(year(day), 9, 1)) AS nine, day AS instant, day - 90 AS duration_start, day AS duration_end, strftime(day, '%m%d') AS era FROM d""")
def dates_in_texts(spark, sf_dir):
    """Order days as headers and keys write them, read again."""
    day, mmdd = F.col("day"), F.lit("1231")
    text = lambda form: F.date_format(day, form)
    ordinal = F.get(F.array(*map(F.lit, ("First", "Second", "Third", "Fourth"))), F.quarter(day) - 1)
    half, nine = fiscal.named_months(F.concat(F.lit("1H"), text("yy")), mmdd), fiscal.named_months(F.concat(F.lit("9M "), text("yyyy")), mmdd)
    duration = fiscal.period_key(F.concat(F.lit("duration_"), F.date_sub(day, 90).cast("string"), F.lit("_"), day.cast("string")))
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct().select(
        "day", fiscal.numeric_date(F.concat(F.lit("at "), text("d/M/yyyy")), F.lit(True)).alias("slashed"), fiscal.numeric_date(text("MM.dd.yy"), F.lit(False)).alias("dotted"), fiscal.day_first(F.concat(text("dd/MM/yyyy"), F.lit(" and more"))).alias("days_first"),
        fiscal.named_quarter(F.concat(F.quarter(day).cast("string"), F.lit("Q"), text("yy")), mmdd).alias("quarter"), fiscal.named_quarter(F.concat(ordinal, F.lit(" quarter of "), text("yyyy")), mmdd).alias("spelled"),
        half["end"].alias("half"), half["months"].alias("half_months"), nine["end"].alias("nine"), fiscal.period_key(F.concat(F.lit("instant_"), day.cast("string")))["end"].alias("instant"), duration["start"].alias("duration_start"),
        duration["end"].alias("duration_end"), fiscal.era(day).alias("era"),
    )


@query("""WITH c AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first, list(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders GROUP BY ALL), o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_orderkey, list_max(list_filter(days, lambda x: day - 1 - x BETWEEN 0 AND 7)) AS opening,
CASE WHEN day = first AND make_date(year(day), 12, 31) - day + 1 BETWEEN 28 AND 349 AND o_orderkey % 5 <> 0 THEN CAST(year(day) AS INTEGER) END AS first_year FROM o JOIN c USING (o_custkey)""")
def openings(spark, sf_dir):
    """The customer's day that each order opens with, at most a week before it, and short first years that began with the first order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    c = o.groupBy("o_custkey").agg(F.min("day").alias("first"), F.collect_set("day").alias("days"))
    end = F.make_date(F.year("day"), F.lit(12), F.lit(31))
    form = F.when(F.col("o_orderkey") % 5 == 0, "10-KT").otherwise("10-K")
    short = fiscal.short_first_year(F.col("day"), end, F.col("first"), F.lit("1231"), form)
    return o.join(c, "o_custkey").select("o_orderkey", fiscal.opening_instant(F.col("day"), F.col("days")).alias("opening"), short["fiscal_year"].alias("first_year"))
