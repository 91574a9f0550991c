"""Companies' filing lists and profiles, earlier filers, namings and periods, over customers and their orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import company
from ..sources import filings
from ..streaming import runs
from .adapters import ORDERS_SQL, Registry, orders, table

query = Registry()
QUERIES, SQL = query.queries, query.sql

_FORMS = "['10-Q', '10-K', '20-F', '8-K'][CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE CASE WHEN o_custkey % 3 = 0 THEN 3 ELSE 4 END END]"


def _lists(spark, sf_dir):
    """A filing list for each customer, as JSON of parallel arrays: each order is a filing, its form by status."""
    status = F.col("o_orderstatus")
    form = F.when(status == "F", "10-Q").when(status == "O", "10-K").when(F.col("o_custkey") % 3 == 0, "20-F").otherwise("8-K")
    rows = orders(spark, sf_dir).select("o_custkey", F.struct("day", "o_orderkey", form.alias("form")).alias("f"))
    each = rows.groupBy("o_custkey").agg(F.sort_array(F.collect_list("f")).alias("f"))
    arrays = F.struct(
        F.transform("f", lambda x: x["o_orderkey"].cast("string")).alias("accessionNumber"), F.transform("f", lambda x: x["day"].cast("string")).alias("filingDate"), F.transform("f", lambda x: x["form"]).alias("form"),
    )
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    whole = each.join(c, "o_custkey").select(F.col("o_custkey").cast("string").alias("cik"), F.col("c_name").alias("name"), F.when(F.col("c_nationkey") % 2 == 0, "1231").otherwise("0630").alias("fiscalYearEnd"), F.struct(arrays.alias("recent")).alias("filings"))
    at = runs.folder(spark, "filing-lists")
    whole.write.json(at)
    return filings.filing_lists(spark, at, lines=True)


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS cik, c_name AS name, CAST(o_orderkey AS VARCHAR) AS accession, CAST(o_orderdate AS DATE) AS filed, {_FORMS} AS form FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderdate >= DATE '1996-01-01' AND {_FORMS} IN ('10-Q', '10-K', '20-F')""")
def listed_reports(spark, sf_dir):
    """Filing lists as JSON of parallel arrays, and the periodic reports in them since a day."""
    found = filings.periodic(_lists(spark, sf_dir), F.lit("1996-01-01").cast("date"))
    return found.select("cik", "name", F.col("accessionNumber").alias("accession"), F.col("filingDate").alias("filed"), "form")


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS cik, any_value(c_name) AS name, CASE WHEN any_value(c_nationkey) % 2 = 0 THEN '1231' ELSE '0630' END AS fiscal_year_end, bool_or({_FORMS} = '20-F') AS foreign_filer, CAST(min(o_orderdate) AS DATE) AS first_filed, CAST(max(o_orderdate) AS DATE) AS last_filed
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey""")
def company_profiles(spark, sf_dir):
    return company.profiles(_lists(spark, sf_dir), "cik").withColumnRenamed("foreign", "foreign_filer")


@query(f"""WITH {ORDERS_SQL}, f AS (SELECT o_custkey, min(day) AS first FROM o WHERE o_orderstatus = 'O' GROUP BY ALL)
SELECT o_custkey, o_orderkey FROM o LEFT JOIN f USING (o_custkey) WHERE o_orderstatus = 'F' AND (first IS NULL OR day < first)""")
def earlier_filers(spark, sf_dir):
    """A customer's finished orders as its earlier filer's, up to the first open one."""
    o = orders(spark, sf_dir)
    earlier = o.where("o_orderstatus = 'F' OR o_orderstatus = 'O'")  # the earlier filer's list holds the current one's too
    return company.before_first(o.where("o_orderstatus = 'O'"), earlier, ["o_custkey"], "day", "o_orderkey").select("o_custkey", "o_orderkey")


@query(f"""WITH {ORDERS_SQL}, p AS (SELECT o_custkey, fiscal_year, fiscal_period, o_orderkey, CAST(last_day(make_date(fiscal_year, 3 * CAST(substr(fiscal_period, 2) AS INTEGER), 1)) - CAST(o_orderkey % 3 * 4 AS INTEGER) AS DATE) AS e, day, o_orderkey % 7 = 0 AS dated FROM o),
n AS (SELECT o_custkey, fiscal_year, fiscal_period, e, count(*) AS n, max(day) AS f, max(day) FILTER (WHERE dated) AS d FROM p GROUP BY ALL),
r AS (SELECT o_custkey, fiscal_year, fiscal_period, CASE WHEN count(d) > 0 THEN arg_max(e, {{d: d, n: n, e: e}}) FILTER (WHERE d IS NOT NULL) ELSE arg_max(e, {{n: n, f: f, e: e}}) END AS reference FROM n GROUP BY ALL)
SELECT o_orderkey, reference, abs(e - reference) <= 6 AS same FROM p JOIN r USING (o_custkey, fiscal_year, fiscal_period)""")
def periods_presented(spark, sf_dir):
    """Orders as presentations of their customer's quarter, dated up to eight days off its end; every seventh dates itself."""
    end = F.date_sub(F.last_day(F.make_date("fiscal_year", 3 * F.substring("fiscal_period", 2, 1).cast("int"), F.lit(1))), (F.col("o_orderkey") % 3 * 4).cast("int"))
    p = orders(spark, sf_dir).withColumn("e", end)
    out = company.same_period(p, ["o_custkey", "fiscal_year", "fiscal_period"], "e", "day", F.col("o_orderkey") % 7 == 0)
    return out.select("o_orderkey", "reference", "same")


@query(f"""WITH {ORDERS_SQL}, y AS (SELECT DISTINCT o_custkey, fiscal_year AS y, CASE WHEN fiscal_year < 1996 AND o_custkey % 2 = 0 THEN '0930' WHEN fiscal_year >= 1998 AND o_custkey % 5 = 0 THEN '0630' ELSE '1231' END AS mmdd FROM o),
i AS (SELECT *, CAST(sum(new) OVER (PARTITION BY o_custkey ORDER BY y) AS INTEGER) AS era FROM (SELECT *, CASE WHEN mmdd = lag(mmdd) OVER (PARTITION BY o_custkey ORDER BY y) THEN 0 ELSE 1 END AS new FROM y)),
e AS (SELECT o_custkey, era, mmdd, min(y) AS a, max(y) AS b FROM i GROUP BY ALL), v AS (SELECT o_custkey, day, CAST(o_orderkey % 2 AS INTEGER) AS x, o_orderkey AS rowid FROM o WHERE o_orderpriority < '4'),
l AS (SELECT o_custkey, era, CAST(strptime(b || mmdd, '%Y%m%d') AS DATE) AS e FROM e), h AS (SELECT v.o_custkey, v.day, x, coalesce(min(l.era) FILTER (WHERE l.e >= v.day), max(l.era)) AS era FROM v JOIN l USING (o_custkey) GROUP BY v.o_custkey, v.day, x, v.rowid),
c AS (SELECT o_custkey, era, x, count(*) AS n, max(day) AS d FROM h GROUP BY ALL), w AS (SELECT o_custkey, era, arg_max(x, {{n: n, d: d, x: -x}}) AS own FROM c GROUP BY ALL)
SELECT o_custkey, era, mmdd, CAST(coalesce(last_value(own IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY era), first_value(own IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY era ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS INTEGER) AS naming FROM e LEFT JOIN w USING (o_custkey, era)""")
def named_eras(spark, sf_dir):
    """Runs of a customer's years that close on one day, and the naming that the votes of its orders give each run."""
    o = orders(spark, sf_dir)
    y = F.col("fiscal_year")
    mmdd = F.when((y < 1996) & (F.col("o_custkey") % 2 == 0), "0930").when((y >= 1998) & (F.col("o_custkey") % 5 == 0), "0630").otherwise("1231")
    years = o.select("o_custkey", F.to_date(F.concat(y.cast("string"), mmdd), "yyyyMMdd").alias("end"), mmdd.alias("mmdd")).distinct()
    votes = o.where("o_orderpriority < '4'").select("o_custkey", F.col("day").alias("end"), (F.col("o_orderkey") % 2).alias("offset"), F.col("day").alias("filed"))
    return company.era_naming(years, votes, ["o_custkey"], "end", "mmdd", "offset", "filed").select("o_custkey", "era", "mmdd", "naming")
