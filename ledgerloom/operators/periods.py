"""Breakdowns' periods that no document reports: a fourth quarter from the year, a year from its quarters, by several ways.

A period is a map from a line's key to its figure. All figures of a group's year are gathered in one row, a few dozen of
them, and the ways are column expressions over the maps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import let

# A worked-out period's parts are off its total by more than this, and a line that is too small to matter.
MOST_GAP, IMMATERIAL = 0.001, 0.01
#: What a row may carry besides group_key, fiscal_year, fiscal_period, kpi_key, value, status and method.
OPTIONAL = {
    "total": "double", "ytd": "double", "ytd_total": "double", "prior": "double", "prior_total": "double", "prior_ytd": "double", "prior_ytd_total": "double", "year_ago": "boolean", "signed": "boolean", "parent": "string",
}
FIGURE = "struct<value:double,status:string,method:string," + ",".join(f"{k}:{t}" for k, t in OPTIONAL.items()) + ">"
ROWS = "array<struct<kpi_key:string,value:double,status:string,note:string,parent:string>>"
QUARTERS = ("Q1", "Q2", "Q3")


def balancing(key: Column) -> Column:
    """Whether a line may turn either way in a quarter: eliminations, hedges, reconciling items, what a split leaves."""
    return key.contains("elimination") | key.contains("hedg") | key.contains("gainsloss") | key.isin("unallocated", "reconcilingitems", "corporate")


def _all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _field(period: Column, name: str) -> Column:
    """The first of a period's rows that has a field."""
    return F.get(F.filter(F.transform(F.map_values(period), lambda v: v[name]), lambda x: x.isNotNull()), 0)


def _same_keys(*periods: Column) -> Column:
    keys = [F.array_sort(F.map_keys(p)) for p in periods]
    return _all([F.coalesce(k == keys[0], F.lit(False)) for k in keys])


def complete(period: Column) -> Column:
    """Whether a period's parts add up to the total that its own report gives."""
    total = _field(period, "total")
    return F.coalesce((total != 0) & (F.abs(_sum(F.transform(F.map_values(period), lambda v: v["value"])) - total) <= F.abs(total) * MOST_GAP), F.lit(False))


def aligned(annual: Column, quarter: Column) -> Column:
    """A quarter laid out like its year.

    Lines that only the year has are zero, if they balance or the quarter is complete. Lines that only the quarter has
    are added to `other` where both have it, left out if each is immaterial, and leave the quarter as it is otherwise.
    """
    zero = F.named_struct(F.lit("value"), F.lit(0.0), F.lit("status"), F.get(F.map_values(quarter), 0)["status"], F.lit("method"), F.get(F.map_values(quarter), 0)["method"], *[x for k, t in OPTIONAL.items() for x in (F.lit(k), F.lit(None).cast(t))])
    filled = F.map_concat(quarter, F.map_from_arrays(*(lambda k: (k, F.transform(k, lambda _: zero.cast(FIGURE))))(F.filter(F.map_keys(annual), lambda k: (balancing(k) | complete(quarter)) & ~F.map_contains_key(quarter, k)))))

    def fold(q: Column) -> Column:
        extra = F.map_filter(q, lambda k, v: ~F.map_contains_key(annual, k))
        own = F.map_filter(q, lambda k, v: F.map_contains_key(annual, k))
        both = F.map_contains_key(annual, F.lit("other")) & F.map_contains_key(q, F.lit("other"))
        size = F.abs(_sum(F.transform(F.map_values(q), lambda v: v["value"])))
        material = F.exists(F.map_values(extra), lambda v: F.abs(v["value"]) >= IMMATERIAL * F.when(size == 0, 1.0).otherwise(size))
        more = _sum(F.transform(F.map_values(extra), lambda v: v["value"]))
        folded = F.transform_values(own, lambda k, v: F.when(k == "other", v.withField("value", v["value"] + more)).otherwise(v))
        return F.when(F.cardinality(extra) == 0, q).when(both, folded).when(material, q).otherwise(own)

    return F.when(quarter.isNotNull(), let(filled, fold))


def nine_months(annual: Column, third: Column, field: str) -> Column:
    """struct(values, total, status): a third quarter's nine months (field `ytd` or `prior_ytd`) on the year's lines; null unless they cover them.

    One balancing line that they leave out is what the others leave of their total.
    """
    known = F.map_filter(F.transform_values(third, lambda k, v: v[field]), lambda k, x: x.isNotNull())
    total = _field(third, f"{field}_total")
    missing = F.filter(F.map_keys(annual), lambda k: balancing(k) & ~F.map_contains_key(known, k))
    rest = F.when(F.size(missing) == 1, F.map_concat(known, F.map_from_arrays(missing, F.array(total - _sum(F.map_values(known)))))).otherwise(known)
    status = F.when(F.forall(F.map_values(third), lambda v: v["status"] == "verified"), "verified").otherwise("needs_review")
    return let(rest, lambda v: F.when(total.isNotNull() & _same_keys(annual, v), F.struct(v.alias("values"), total.alias("total"), status.alias("status"))))


def _judged(rows: Column, total: Column) -> Column:
    """Rows of a worked-out period: too far from its total they need review, and one that does makes all do. Lines of another row count in that row."""
    keys = F.transform(rows, lambda r: r["kpi_key"])
    top = F.filter(rows, lambda r: ~F.coalesce(F.array_contains(keys, r["parent"]), F.lit(False)))
    error = (_sum(F.transform(top, lambda r: r["value"])) - total) / total
    far = F.coalesce((total != 0) & (F.abs(error) > MOST_GAP), F.lit(False))
    each = F.transform(rows, lambda r: F.when(far & (r["status"] == "verified"), r.withField("status", F.lit("needs_review")).withField("note", F.lit("the parts do not add up to the derived total"))).otherwise(r))
    whole = lambda a: F.forall(a, lambda r: r["status"] == "verified")
    flag = lambda r: F.when(r["status"] == "verified", r.withField("status", F.lit("needs_review")).withField("note", F.lit("a part beside it needs review"))).otherwise(r)
    return let(each, lambda a: F.when(whole(a), a).otherwise(F.transform(a, flag)))


def _row(key: Column, value: Column, verified: Column, base: Column, later: Column) -> Column:
    negative = (value < 0) & (base["value"] >= 0) & ~balancing(key) & ~F.coalesce(base["signed"], F.lit(False))
    status = F.when(later, "rejected").when(verified & ~negative, "verified").otherwise("needs_review")
    note = F.when(later, "the quarters are a later report's, the year is not").when(negative, "the rest of the year is below zero").when(~verified, "made of figures that need review")
    return F.struct(key.alias("kpi_key"), value.alias("value"), status.alias("status"), note.alias("note"), base["parent"].alias("parent"))


def less_quarters(annual: Column, quarters: list[Column]) -> Column:
    """The year less its quarters, line by line; null unless all have the same lines.

    A quarter taken from a later report is on that report's basis, and never combines with a year as first reported.
    """

    def one(key: Column) -> Column:
        base, parts = annual[key], [q[key] for q in quarters]
        later = reduce(lambda a, b: a | b, [F.coalesce(p["year_ago"], F.lit(False)) for p in parts]) & ~F.coalesce(base["year_ago"], F.lit(False))
        return _row(key, base["value"] - reduce(lambda a, b: a + b, [p["value"] for p in parts]), _all([x["status"] == "verified" for x in [base, *parts]]), base, later)

    total = _field(annual, "total") - reduce(lambda a, b: a + b, [_field(q, "total") for q in quarters])
    return F.when(_same_keys(annual, *quarters), _judged(F.transform(F.map_keys(annual), one), total))


def less_nine_months(annual: Column, nine: Column) -> Column:
    """The year less its first nine months."""
    one = lambda key: _row(key, annual[key]["value"] - nine["values"][key], (annual[key]["status"] == "verified") & (nine["status"] == "verified"), annual[key], F.lit(False))
    return F.when(nine.isNotNull(), _judged(F.transform(F.map_keys(annual), one), _field(annual, "total") - nine["total"]))


def restated_year(annual: Column, following: Column, own_total: bool = False) -> Column:
    """The year as the next year's report restates it, on that report's lines; null unless it covers them and adds up.

    It adds up to the total restated beside it, with own_total to the year's total as first reported.
    """
    first = _field(annual, "total")
    total = first if own_total else F.coalesce(_field(following, "prior_total"), first)
    priors = F.transform(F.map_values(following), lambda v: v["prior"])
    fits = F.forall(priors, lambda x: x.isNotNull()) & (F.abs(_sum(F.transform(priors, lambda x: F.coalesce(x, F.lit(0.0)))) - total) <= F.abs(total) * MOST_GAP)
    year = F.transform_values(following, lambda k, v: v.withField("value", v["prior"]).withField("total", total).withField("year_ago", F.lit(not own_total)))
    return F.when(F.coalesce(fits, F.lit(False)), year)


def derive_periods(values: DataFrame) -> DataFrame:
    """(group_key, fiscal_year, fiscal_period, kpi_key, value, status, note): fourth quarters and years that are worked out.

    Only verified rows count. A fourth quarter that isn't reported is, by the first way all of whose rows are verified, or
    else the first: the year less its nine months, less those that next year's third quarter restates, the restated year
    less quarters that are restated too, the year less its quarters, the restated year less its restated nine months. A
    line below zero that can't be makes the whole quarter rejected. A year that isn't reported is the sum of four
    quarters read from releases (method `ai`) that have the same lines.
    """
    have = values.columns
    rows = values.where("status = 'verified'").select(
        "group_key", F.col("fiscal_year").cast("int").alias("fiscal_year"), "fiscal_period", "kpi_key",
        F.struct(F.col("value").cast("double").alias("value"), "status", "method", *[(F.col(k) if k in have else F.lit(None)).cast(t).alias(k) for k, t in OPTIONAL.items()]).alias("f"),
    )
    pick = lambda p: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("fiscal_period") == p, F.struct("kpi_key", "f")))))
    years = rows.groupBy("group_key", "fiscal_year").agg(*[pick(p).alias(p) for p in (*QUARTERS, "Q4", "FY")])
    some = lambda c: F.when(F.cardinality(c) > 0, F.col(c))
    years = years.select("group_key", "fiscal_year", *[some(p).alias(p) for p in (*QUARTERS, "Q4", "FY")])
    after = years.select("group_key", (F.col("fiscal_year") - 1).alias("fiscal_year"), F.col("FY").alias("next_FY"), F.col("Q3").alias("next_Q3"))
    years = years.join(after, ["group_key", "fiscal_year"], "left")
    year, own = F.col("FY"), [F.col(q) for q in QUARTERS]
    method = lambda p: F.get(F.map_values(p), 0)["method"]
    derived = lambda p: F.forall(F.map_values(p), lambda v: v["method"] == "derived")
    every = _all([year.isNotNull(), *[q.isNotNull() for q in own]])
    years = years.withColumns({f"a{q}": F.when(every, aligned(year, F.col(q))) for q in QUARTERS})
    laid = [F.col(f"a{q}") for q in QUARTERS]
    first = F.get(F.map_keys(year), 0)
    later = F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(q[first]["year_ago"], F.lit(False)) for q in laid]) & ~F.coalesce(year[first]["year_ago"], F.lit(False)), F.lit(False))
    years = years.withColumns({
        "nine": nine_months(year, F.col("Q3"), "ytd"), "restated_nine": nine_months(year, F.col("next_Q3"), "prior_ytd"), "later_year": F.when(later, restated_year(year, F.col("next_FY"))),
        "restated": restated_year(year, F.col("next_FY"), own_total=True),
    })
    years = years.withColumn("restated_year_nine", F.when(F.col("restated").isNotNull(), nine_months(F.col("next_FY"), F.col("next_Q3"), "prior_ytd")))
    ways = {
        "w1": less_nine_months(year, F.col("nine")), "w2": less_nine_months(year, F.col("restated_nine")), "w3": F.when(F.col("later_year").isNotNull(), less_quarters(F.col("later_year"), laid)),
        "w4": less_quarters(year, laid), "w5": less_nine_months(F.col("restated"), F.col("restated_year_nine")),
    }
    fourth = F.col("Q4").isNull() | derived(F.col("Q4"))
    years = years.withColumns({k: F.when(year.isNotNull() & method(year).isin("xbrl", "ai") & fourth, w) for k, w in ways.items()})
    tried = F.filter(F.array(*ways), lambda a: a.isNotNull() & (F.size(a) > 0))
    good = F.filter(tried, lambda a: F.forall(a, lambda r: r["status"] == "verified"))
    years = years.withColumn("chosen", F.coalesce(F.get(good, 0), F.get(tried, 0)))
    below = F.exists("chosen", lambda r: F.coalesce(r["note"] == "the rest of the year is below zero", F.lit(False)))
    reject = lambda r: r.withField("status", F.lit("rejected")).withField("note", F.lit("its quarters are laid out in other lines"))
    q4 = F.when(below, F.transform("chosen", reject)).otherwise(F.col("chosen"))
    four = [*[F.when(every, a).otherwise(q) for a, q in zip(laid, own)], F.col("Q4")]
    added = F.transform(F.map_keys(F.col("Q4")), lambda k: F.struct(k.alias("kpi_key"), reduce(lambda a, b: a + b, [q[k]["value"] for q in four]).alias("value"), F.lit("verified").alias("status"), F.lit(None).cast("string").alias("note"), F.col("Q4")[k]["parent"].alias("parent")))
    fit = (year.isNull() | derived(year)) & _all([q.isNotNull() for q in four]) & _same_keys(*four) & _all([method(q) == "ai" for q in four])
    fy = F.when(fit, _judged(added, reduce(lambda a, b: a + b, [_field(q, "total") for q in four])))
    parts = F.array(F.struct(F.lit("Q4").alias("fiscal_period"), q4.cast(ROWS).alias("rows")), F.struct(F.lit("FY").alias("fiscal_period"), fy.cast(ROWS).alias("rows")))
    out = years.select("group_key", "fiscal_year", F.explode(parts).alias("p")).select("group_key", "fiscal_year", "p.fiscal_period", F.explode("p.rows").alias("r"))
    return out.select("group_key", "fiscal_year", "fiscal_period", "r.kpi_key", "r.value", "r.status", "r.note")


def same_derivation(stored: DataFrame, derived: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys): derived rows that a stored one already says, in all fields; the rest has to be written."""
    both = stored.select(*keys, F.struct(*fields).alias("_s")).join(derived.select(*keys, F.struct(*fields).alias("_d")), keys)
    return both.where(F.col("_s").eqNullSafe(F.col("_d"))).select(*keys)


def paired_vintages(nines: DataFrame, years: DataFrame, keys: list[str], least: int = 60, most: int = 105, apart: int = 200) -> DataFrame:
    """(keys, nine_id, year_id): for each key the newest nine months that pair with a year of their vintage.

    nines and years: keys, id, filed, period_start, period_end. The year is the first one filed after the nine months,
    within `apart` days; it opens on the same day and closes `least` to `most` days after them.
    """
    n = nines.select(*keys, *[F.col(c).alias(f"n_{c}") for c in ("id", "filed", "period_start", "period_end")])
    both = n.join(years.select(*keys, "id", "filed", "period_start", "period_end"), keys).where("filed > n_filed")
    first = both.groupBy(*keys, "n_id", "n_filed", "n_period_start", "n_period_end").agg(F.min(F.struct("filed", "id", "period_start", "period_end")).alias("_year"))
    quarter, gap = F.date_diff("_year.period_end", "n_period_end"), F.date_diff("_year.filed", "n_filed")
    opens = F.coalesce(F.col("_year.period_start") == F.col("n_period_start"), F.lit(True))
    fits = first.where((gap <= apart) & quarter.between(least, most) & opens)
    best = fits.groupBy(*keys).agg(F.max(F.struct("n_filed", "n_id", "_year.id")).alias("b"))
    return best.select(*keys, F.col("b.n_id").alias("nine_id"), F.col("b.id").alias("year_id"))


def counterparts(lines: DataFrame, others: DataFrame, keys: list[str], least: float = 0.6) -> DataFrame:
    """(keys, line, other): the line of another presentation that each line pairs with, within their shared key.

    lines and others: keys, line (a number), concept, label. The only one on each side; else of the same concept, else of
    the closest label, `least` of all words shared at least, and of the same repeat among its equals.
    """
    from .evaluate import likeness

    l = lines.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("line", "concept", "label"))).alias("mine"))  # noqa: E741
    o = others.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("line", "concept", "label"))).alias("theirs"))

    def other(x: Column) -> Column:
        same = F.filter("theirs", lambda y: y["concept"] == x["concept"])
        peers = F.filter("mine", lambda y: y["concept"] == x["concept"])
        scored = F.transform("theirs", lambda y: F.struct(likeness(x["label"], y["label"]).alias("s"), y.alias("y")))
        best = F.array_max(F.transform(scored, lambda z: z["s"]))
        close = F.when(best >= least, F.transform(F.filter(scored, lambda z: z["s"] == best), lambda z: z["y"]))
        alike = F.filter("mine", lambda y: F.lower(y["label"]) == F.lower(x["label"]))
        found, own = F.when(F.size(same) > 0, same).otherwise(close), F.when(F.size(same) > 0, peers).otherwise(alike)
        nth = F.size(F.filter(own, lambda y: y["line"] < x["line"]))
        return F.when((F.size("mine") == 1) & (F.size("theirs") == 1), F.get("theirs", 0)["line"]).otherwise(F.get(found, nth)["line"])

    pairs = F.transform("mine", lambda x: F.struct(x["line"].alias("line"), other(x).alias("other")))
    return l.join(o, keys).select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*").where("other IS NOT NULL")
