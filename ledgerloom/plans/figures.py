"""Figures, their rounding and their texts, over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, rounding
from .adapters import Registry, table

query = Registry()
QUERIES, SQL = query.queries, query.sql

_V = "v AS (SELECT o_orderkey AS k, o_totalprice AS v, floor(o_totalprice) AS t, 1000 * floor(o_totalprice / 1000) AS th, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"


def _values(spark, sf_dir):
    v = F.col("o_totalprice")
    whole = lambda c: F.floor(c).cast("double")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), v.alias("v"), whole(v).alias("t"), (whole(v / 1000) * 1000).alias("th"))


def _unit(x: str) -> str:
    return f"CASE WHEN {x} = 0 THEN 1.0 ELSE least(power(10.0, length(regexp_extract(CAST(CAST({x} AS BIGINT) AS VARCHAR), '(0*)$', 1))), 1e12) END"


def _tolerance(x: str) -> str:
    return f"greatest(CASE WHEN {x} = 0 THEN 1.0 ELSE least({_unit(x)}, power(10.0, greatest(length(CAST(CAST({x} AS BIGINT) AS VARCHAR)) - 2, 0))) END / 2, 0.5)"


@query(f"""WITH {_V}, p AS (SELECT *, list_filter(range(7), lambda d: abs(v * power(10.0, d) - round_even(v * power(10.0, d), 0)) < 1e-6 * greatest(1.0, v * power(10.0, d)))[1] AS places FROM v)
SELECT k, CAST(places AS INTEGER) AS places, {_unit('th')} AS unit, CASE WHEN places > 0 THEN 0.5 * power(10.0, -places) ELSE {_tolerance('round(v)')} END AS of_printed, {_tolerance('th')} AS of_thousands,
CASE WHEN th < 100 THEN v - th <= 1e-9 ELSE v - th <= {_tolerance('th')} END AS is_evidence, greatest(0.5, power(10.0, k % 5 - 2) / 2) AS of_decimals FROM p""")
def stated_tolerances(spark, sf_dir):
    """Decimals, rounding unit and tolerance of order totals as printed, in whole units and in thousands; what a tagged figure proves."""
    v, th = F.col("v"), F.col("th")
    return _values(spark, sf_dir).select(
        "k", rounding.places(v).cast("int").alias("places"), rounding.rounding_unit(th).alias("unit"), rounding.stated_tolerance(v).alias("of_printed"), rounding.stated_tolerance(th).alias("of_thousands"),
        rounding.is_evidence(v, th).alias("is_evidence"), rounding.reported_tolerance(2 - F.col("k") % 5).alias("of_decimals"),
    )


@query(f"""WITH {_V}, o AS (SELECT *, CASE WHEN k % 2 = 0 THEN v * (1 + 1e-12) ELSE v * (1 + 1e-7) END AS noisy, CASE WHEN k % 3 = 0 THEN v * 1.004 ELSE v * 1.006 END AS off FROM v)
SELECT k, k % 2 = 0 AS same, t - th <= greatest({_unit('t')}, {_unit('th')}, 1.0) AS agree, {_unit('t')} < {_unit('th')} AND t - th <= {_unit('th')} / 2 AS refines, t - th <= greatest({_unit('t')}, {_unit('th')}) / 2 AS same_to_zeros,
1000 * th >= 1e6 AND length(regexp_replace(CAST(CAST(1000 * th AS BIGINT) AS VARCHAR), '0+$', '')) >= 3 AS significant, k % 3 <> 0 AS differs, CASE WHEN th <> 0 THEN (t - th) / th END AS gap FROM o""")
def figure_agreement(spark, sf_dir):
    """Order totals against themselves in thousands, with noise and half a percent off."""
    k, v, t, th = (F.col(c) for c in ("k", "v", "t", "th"))
    noisy, off = v * (1 + F.when(k % 2 == 0, 1e-12).otherwise(1e-7)), v * F.when(k % 3 == 0, 1.004).otherwise(1.006)
    return _values(spark, sf_dir).select(
        "k", rounding.same_figure(v, noisy).alias("same"), rounding.agree(t, th).alias("agree"), rounding.refines(t, th).alias("refines"), rounding.same_to_zeros(t, th).alias("same_to_zeros"),
        rounding.significant(th * 1000).alias("significant"), rounding.differs(v, off).alias("differs"), rounding.relative_gap(t, th).alias("gap"),
    )


_FRACTIONS = """r AS (SELECT DISTINCT CAST(l_quantity AS INTEGER) AS a, CAST(l_linenumber AS INTEGER) AS b, l_quantity / l_linenumber AS ratio, greatest(l_quantity / l_linenumber, l_linenumber / l_quantity) AS up FROM lineitem),
f AS (SELECT a, b, ratio, up, round_even(up, 0) AS w, arg_min({d: d, n: round_even(up * d, 0)}, {gap: abs(round_even(up * d, 0) / d - up), d: d}) AS x FROM r, (VALUES (1), (2), (3), (4)) t(d) GROUP BY ALL)"""


@query(f"""WITH {_FRACTIONS}, c AS (SELECT *, CASE WHEN w <= 100 THEN abs(w - up) END AS gw, CASE WHEN x.d > 1 AND x.n <= 10 THEN abs(x.n / x.d - up) END AS gf, x.n / x.d AS q FROM f),
b AS (SELECT *, CASE WHEN gw IS NOT NULL AND (gf IS NULL OR gw <= gf) THEN w WHEN gf IS NOT NULL THEN q END AS best FROM c)
SELECT a, b, CASE WHEN best >= 1.2 THEN CASE WHEN ratio >= 1 THEN best ELSE 1 / best END END AS declared, CASE WHEN q >= 1.25 AND abs(q - up) <= 0.01 * up THEN CASE WHEN ratio >= 1 THEN q ELSE 1 / q END END AS clean,
abs((ratio - 1) * 100 - (CAST(a AS DOUBLE) / b - 1) * 100) <= 0.1 AS growth FROM b""")
def split_ratios(spark, sf_dir):
    """Quantities over line numbers as measured split ratios: the ratio that was declared, the clean one, the growth they state."""
    r = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("int").alias("a"), F.col("l_linenumber").cast("int").alias("b"), (F.col("l_quantity") / F.col("l_linenumber")).alias("ratio")).distinct()
    growth = rounding.growth_matches(F.col("a").cast("double"), F.col("b").cast("double"), (F.col("ratio") - 1) * 100)
    return r.select("a", "b", rounding.declared_ratio(F.col("ratio")).alias("declared"), rounding.clean_ratio(F.col("ratio")).alias("clean"), growth.alias("growth"))


@query(f"""WITH {_V} SELECT k, CAST(1 + k % 2 AS INTEGER) AS decimals, 0.5 * power(10.0, -(1 + k % 2)) * 1e6 AS half, power(10.0, k % 4) AS step, CASE WHEN k % 5 = 0 THEN NULL ELSE power(10.0, 3 * (k % 3)) END AS unit, v AS fifteen FROM v WHERE cents > 0""")
def printed_places(spark, sf_dir):
    """Order totals printed with one or two decimals, as multiples of a power of ten, and against the cell they were read from."""
    k, v, t = F.col("k"), F.col("v"), F.col("t")
    text = F.when(k % 2 == 0, F.format_number(v, 1)).otherwise(F.format_number(v, 2))
    ten = F.pow(F.lit(10.0), k % 4)
    many = F.array((10 * t + 1) * ten, (10 * t + 3) * ten, F.lit(0.0))
    cell = v * F.when(k % 5 == 0, 2.0).otherwise(1.01)
    return _values(spark, sf_dir).where("v > 0").select(
        "k", numbers.decimals(text).alias("decimals"), rounding.printed_half(text, F.lit(1e6)).alias("half"), rounding.coarsest_step(many).alias("step"),
        rounding.release_unit(v * F.pow(F.lit(10.0), 3 * (k % 3)), cell).alias("unit"), numbers.fifteen_digits(v * 3 / 3).alias("fifteen"),
    )


@query("""SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN -CAST(floor(o_totalprice) AS DOUBLE) WHEN 1 THEN CAST(floor(o_totalprice) AS DOUBLE) WHEN 2 THEN 0.0 END AS value, 'Order ' || o_orderkey || ' of customer' AS clean FROM orders""")
def statement_numbers(spark, sf_dir):
    """Order totals as a statement prints them: in brackets, with a currency mark, as a dash, and in prose, which is no number."""
    k, t = F.col("k"), F.format_number("t", 0)
    text = F.when(k % 4 == 0, F.concat(F.lit("( "), t, F.lit(" )"))).when(k % 4 == 1, F.concat(F.lit("$ "), t)).when(k % 4 == 2, "—").otherwise(F.concat(t, F.lit(" in all")))
    untidy = F.concat(F.lit("\t Order   "), k.cast("string"), F.lit("  of\n customer "))
    return _values(spark, sf_dir).select("k", numbers.statement_number(text).alias("value"), numbers.clean(untidy).alias("clean"))


@query("""SELECT p_partkey, CAST(p_size * CASE p_partkey % 3 WHEN 0 THEN 1000000 ELSE 1 END AS DOUBLE) AS value, CASE p_partkey % 3 WHEN 0 THEN 'million' END AS scale_word FROM part WHERE p_size BETWEEN 1 AND 99""")
def spelled_numbers(spark, sf_dir):
    """Part sizes spelled out in a sentence and read again."""
    ones = F.array(*map(F.lit, numbers._ONES))
    tens = F.array(*map(F.lit, ["", "", "twenty", *numbers._TENS]))
    n = F.col("p_size")
    ten, one = F.get(tens, F.floor(n / 10).cast("int")), F.get(ones, n % 10)
    spelled = F.when(n < 20, F.get(ones, n)).when(n % 10 == 0, ten).otherwise(F.concat(ten, F.lit("-"), one))
    text = F.concat(F.lit("We hold "), spelled, F.when(F.col("p_partkey") % 3 == 0, " million").otherwise(""), F.lit(" of it"))
    found = numbers.word_number(text)
    return table(spark, sf_dir, "part").where("p_size BETWEEN 1 AND 99").select("p_partkey", found["value"].alias("value"), found["scale_word"].alias("scale_word"))


@query("""WITH b AS (SELECT o_custkey, year(o_orderdate) AS y, list(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS x, count(*) AS n, CAST(sum(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS DOUBLE) * 1e3 AS s FROM orders GROUP BY ALL),
r AS (SELECT *, 1e6 * round(s / 1e6 + 0.2) AS sibling FROM b), u AS (SELECT *, 3e6 + s AS total FROM r)
SELECT o_custkey, CAST(y AS INTEGER) AS y, CASE WHEN sibling >= 1e6 AND abs(s - sibling) <= power(10.0, length(regexp_extract(CAST(CAST(sibling AS BIGINT) AS VARCHAR), '(0*)$', 1))) / 2 THEN s END AS rest FROM u""")
def refined_rests(spark, sf_dir):
    """What a customer's year leaves of a total, where a figure in millions is that rest rounded."""
    thousands = F.floor(F.col("o_totalprice") / 1000).cast("double")
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg((F.sum(thousands) * 1000).alias("s"))
    sibling = F.round(F.col("s") / 1e6 + 0.2) * 1e6
    return rows.select("o_custkey", "y", rounding.refined_rest(F.lit(3e6), sibling, F.lit(3e6) + F.col("s"), F.lit(1e5)).alias("rest"))
