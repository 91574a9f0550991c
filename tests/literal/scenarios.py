"""Operators over small literal tables; the SQL lists the rows that have to come out, written by hand."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import breakdowns, periods
from .cases import values_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
d = dt.date


class Tables:
    """Makes literal tables."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def __call__(self, schema: str, rows: list[tuple]) -> DataFrame:
        kinds = [x.split(" ", 1)[1] for x in schema.split(", ")]
        fixed = [tuple(float(x) if k == "double" and x is not None else x for x, k in zip(r, kinds)) for r in rows]
        return self.spark.createDataFrame(fixed, schema)


def scenario(outputs: str, want: list[tuple]):
    """A query of a function of literal tables, and the rows it has to give."""

    def add(make: Callable[[Tables], DataFrame]) -> Callable:
        names = [x.split()[0] for x in outputs.split(", ")]
        QUERIES[make.__name__] = lambda spark, sf_dir: make(Tables(spark)).select(*names)
        SQL[make.__name__] = values_sql(outputs, want)
        return make

    return add


# Worked-out periods -----------------------------------------------------------------------------------------------------

_FIELDS = "group_key string, fiscal_year int, fiscal_period string, kpi_key string, value double, status string, method string, total double, ytd double, ytd_total double, prior double, prior_total double, prior_ytd double, prior_ytd_total double, year_ago boolean, signed boolean, parent string"
_NAMES = [x.split()[0] for x in _FIELDS.split(", ")]


def _row(group, year, period, key, value, status="verified", method="xbrl", **more):
    return tuple({"group_key": group, "fiscal_year": year, "fiscal_period": period, "kpi_key": key, "value": float(value), "status": status, "method": method, **{k: float(x) if isinstance(x, int) and not isinstance(x, bool) else x for k, x in more.items()}}.get(n) for n in _NAMES)


def _quarters(group, year, lines: dict, quarters=("Q1", "Q2", "Q3"), **more):
    return [_row(group, year, q, k, v[i], **more) for i, q in enumerate(quarters) for k, v in lines.items()]


_AB = {"a": (20, 25, 30), "b": (10, 10, 10)}
_DERIVED = [
    *[_row("less_quarters", 2026, "FY", k, v) for k, v in (("a", 100), ("b", 40))], *_quarters("less_quarters", 2026, _AB),
    *[_row("renamed", 2026, "FY", k, v) for k, v in (("a", 100), ("b", 40))], *_quarters("renamed", 2026, {"a": (20, 25, 30)}), _row("renamed", 2026, "Q1", "c", 10), _row("renamed", 2026, "Q2", "b", 10), _row("renamed", 2026, "Q3", "b", 10),
    _row("negative", 2026, "FY", "a", 50), *_quarters("negative", 2026, {"a": (20, 20, 20)}),
    *_quarters("releases", 2026, {"a": (10, 10, 10, 10)}, ("Q1", "Q2", "Q3", "Q4"), method="ai"),
    *[_row("flagged", 2026, "FY", k, v, method="ai") for k, v in (("a", 100), ("b", 40))], *_quarters("flagged", 2026, _AB, method="ai"), *_quarters("flagged", 2026, {"n3": (5, 5, 5, 6)}, ("Q1", "Q2", "Q3", "Q4"), method="ai", status="needs_review"),
    *[_row("nine_months", 2026, "FY", k, v, total=140) for k, v in (("a", 100), ("b", 40))], *[_row("nine_months", 2026, q, k, v) for q, k, v in (("Q1", "a", 99), ("Q1", "b", 1), ("Q2", "a", 25), ("Q2", "b", 10))],
    _row("nine_months", 2026, "Q3", "a", 30, total=40, ytd=70, ytd_total=100), _row("nine_months", 2026, "Q3", "b", 10, total=40, ytd=30, ytd_total=100),
    *[_row("laid_out", 2026, "FY", k, v) for k, v in (("us", 100), ("other", 60))], *_quarters("laid_out", 2026, {"us": (20, 20, 20), "other": (5, 5, 5), "europe": (7, 7, 7), "tiny": (0.5, 0.5, 0.5)}),
    *[_row("off_total", 2026, "FY", k, v, total=150) for k, v in (("a", 120), ("b", 30))], _row("off_total", 2026, "Q3", "a", 30, total=40, ytd=30, ytd_total=100), _row("off_total", 2026, "Q3", "b", 10, total=40, ytd=10, ytd_total=100),
    *[_row("recast", 2023, "FY", k, v, total=200) for k, v in (("a", 100), ("b", 60), ("c", 40))], *[_row("recast", 2023, "Q3", k, 30, total=60, ytd=70, ytd_total=150) for k in "ab"],
    *[_row("recast", 2024, "Q3", k, 1, total=3, prior_ytd=v, prior_ytd_total=150) for k, v in (("a", 70), ("b", 45), ("c", 35))],
    *[_row("new_layout", 2023, "FY", k, v, total=200) for k, v in (("a", 100), ("b", 60), ("d", 40))], *[_row("new_layout", 2024, "FY", k, v, total=230, prior=p) for k, v, p in (("a", 110, 95), ("e", 120, 105))],
    *[_row("new_layout", 2024, "Q3", k, 1, total=2, prior_ytd=p, prior_ytd_total=150) for k, p in (("a", 70), ("e", 80))],
    *[_row("next_way", 2025, "FY", k, v, total=63.5) for k, v in (("products", 44.5), ("services", 19))], _row("next_way", 2025, "Q3", "products", 9, total=16, ytd=25.5, ytd_total=45.5), _row("next_way", 2025, "Q3", "services", 7, total=16, ytd=20, ytd_total=45.5),
    *[_row("next_way", 2026, "Q3", k, 1, total=2, prior_ytd=p, prior_ytd_total=45.5) for k, p in (("products", 31.5), ("services", 14))],
    *[_row("zero_rest", 2019, "FY", k, v, total=161) for k, v in (("google", 160), ("otherbets", 0.75), ("unallocated", 0.25))], *_quarters("zero_rest", 2019, {"google": (36, 36, 36), "otherbets": (0.25, 0.25, 0.25)}, total=36.25),
    *[_row("balancing", 2020, "FY", k, v, total=182527) for k, v in (("googleservices", 168635), ("googlecloud", 13059), ("otherbets", 657), ("unallocated", 176))],
    *[_row("balancing", 2020, "Q3", k, 1, total=4, ytd=v, ytd_total=125629) for k, v in (("googleservices", 115762), ("googlecloud", 9228), ("otherbets", 461), ("unallocated", 178))],
    *[_row("ramp", 2018, "FY", k, v, total=130, method="ai") for k, v in (("n7", 30), ("n16", 100))], _row("ramp", 2018, "Q1", "n16", 25, total=25, method="ai"), *[_row("ramp", 2018, q, k, v, total=t, method="ai") for q, k, v, t in (("Q2", "n7", 5, 30), ("Q2", "n16", 25, 30), ("Q3", "n7", 10, 35), ("Q3", "n16", 25, 35))],
    _row("loss", 2025, "FY", "other", 264, signed=True), *_quarters("loss", 2025, {"other": (103, 69, 100)}, signed=True),
    *[_row("levels", 2026, q, k, v[i], method="ai", total=t, parent="fees" if k in ("credit", "equity") else None) for i, (q, t) in enumerate((("Q1", 740), ("Q2", 800), ("Q3", 860), ("Q4", 890))) for k, v in {"fees": (600, 650, 700, 720), "credit": (440, 470, 500, 520), "equity": (160, 180, 200, 200), "other": (140, 150, 160, 170)}.items()],
    *[_row("later_basis", 2026, "FY", k, v) for k, v in (("a", 100), ("b", 40))], *_quarters("later_basis", 2026, _AB, year_ago=True),
    *[_row("one_basis", 2026, "FY", k, v, year_ago=True) for k, v in (("a", 100), ("b", 40))], *_quarters("one_basis", 2026, _AB, year_ago=True),
    *[_row("restated", 2018, "FY", k, v, total=100) for k, v in (("a", 61), ("b", 39))], *[_row("restated", 2018, q, k, v, total=t, year_ago=True) for q, a, b, t in (("Q1", 14, 10, 24), ("Q2", 15, 10, 25), ("Q3", 16, 10, 26)) for k, v in (("a", a), ("b", b))],
    *[_row("restated", 2019, "FY", k, v, prior=p, total=110) for k, v, p in (("a", 70, 60), ("b", 40, 40))],
]
_v, _n, _r = "verified", "needs_review", "rejected"


@scenario("group_key string, fiscal_year int, fiscal_period string, kpi_key string, value double, status string", [
    ("less_quarters", 2026, "Q4", "a", 25, _v), ("less_quarters", 2026, "Q4", "b", 10, _v), ("negative", 2026, "Q4", "a", -10, _r), ("releases", 2026, "FY", "a", 40, _v), ("flagged", 2026, "Q4", "a", 25, _v), ("flagged", 2026, "Q4", "b", 10, _v),
    ("nine_months", 2026, "Q4", "a", 30, _v), ("nine_months", 2026, "Q4", "b", 10, _v), ("laid_out", 2026, "Q4", "us", 40, _v), ("laid_out", 2026, "Q4", "other", 22.5, _v), ("off_total", 2026, "Q4", "a", 90, _n), ("off_total", 2026, "Q4", "b", 20, _n),
    ("recast", 2023, "Q4", "a", 30, _v), ("recast", 2023, "Q4", "b", 15, _v), ("recast", 2023, "Q4", "c", 5, _v), ("new_layout", 2023, "Q4", "a", 25, _v), ("new_layout", 2023, "Q4", "e", 25, _v), ("next_way", 2025, "Q4", "products", 13, _v), ("next_way", 2025, "Q4", "services", 5, _v),
    ("zero_rest", 2019, "Q4", "google", 52, _v), ("zero_rest", 2019, "Q4", "otherbets", 0, _v), ("zero_rest", 2019, "Q4", "unallocated", 0.25, _v), ("balancing", 2020, "Q4", "googleservices", 52873, _v), ("balancing", 2020, "Q4", "googlecloud", 3831, _v), ("balancing", 2020, "Q4", "otherbets", 196, _v), ("balancing", 2020, "Q4", "unallocated", -2, _v),
    ("ramp", 2018, "Q4", "n7", 15, _v), ("ramp", 2018, "Q4", "n16", 25, _v), ("loss", 2025, "Q4", "other", -8, _v), ("levels", 2026, "FY", "fees", 2670, _v), ("levels", 2026, "FY", "credit", 1930, _v), ("levels", 2026, "FY", "equity", 740, _v), ("levels", 2026, "FY", "other", 620, _v),
    ("later_basis", 2026, "Q4", "a", 25, _r), ("later_basis", 2026, "Q4", "b", 10, _r), ("one_basis", 2026, "Q4", "a", 25, _v), ("one_basis", 2026, "Q4", "b", 10, _v), ("restated", 2018, "Q4", "a", 15, _v), ("restated", 2018, "Q4", "b", 10, _v),
])
def derive_ways(t):
    return periods.derive_periods(t(_FIELDS, _DERIVED))


@scenario("g string, k string", [("g", "same")])
def same_derivation(t):
    schema = "g string, k string, value double, status string, inputs string"
    stored = t(schema, [("g", "same", 5, "verified", "Q1,Q2"), ("g", "value", 5, "verified", "Q1"), ("g", "inputs", 5, "verified", None)])
    derived = t(schema, [("g", "same", 5, "verified", "Q1,Q2"), ("g", "value", 6, "verified", "Q1"), ("g", "inputs", 5, "verified", "Q1"), ("g", "new", 1, "verified", "Q1")])
    return periods.same_derivation(stored, derived, ["g", "k"], ["value", "status", "inputs"])


@scenario("y int, nine_id string, year_id string", [(2002, "10q-2003", "10k-2003"), (2004, "10q", "10k")])
def paired_vintages(t):
    schema = "y int, id string, filed date, period_start date, period_end date"
    nines = t(schema, [(2002, "10q-2002", d(2002, 11, 1), d(2002, 1, 1), d(2002, 9, 30)), (2002, "10q-2003", d(2003, 11, 1), d(2002, 1, 1), d(2002, 9, 30)), (2004, "10q", d(2004, 11, 1), d(2004, 1, 1), d(2004, 9, 30)), (2005, "late", d(2005, 11, 1), d(2005, 1, 1), d(2005, 9, 30)), (2006, "short", d(2006, 11, 1), d(2006, 7, 1), d(2006, 9, 30))])
    years = t(schema, [(2002, "10k-2002", d(2003, 3, 1), d(2002, 1, 1), d(2002, 12, 31)), (2002, "10k-2003", d(2004, 3, 1), d(2002, 1, 1), d(2002, 12, 31)), (2004, "10k", d(2005, 3, 1), d(2004, 1, 1), d(2004, 12, 31)), (2005, "10k-late", d(2006, 9, 1), d(2005, 1, 1), d(2005, 12, 31)), (2006, "10k-short", d(2007, 3, 1), d(2006, 1, 1), d(2006, 12, 31))])
    return periods.paired_vintages(nines, years, ["y"])


@scenario("k string, line int, other int", [("one", 1, 7), ("concept", 1, 4), ("concept", 2, 5), ("label", 1, 3), ("label", 2, 2)])
def counterparts(t):
    schema = "k string, line int, concept string, label string"
    lines = t(schema, [("one", 1, None, "Sales"), ("concept", 1, "c", "A"), ("concept", 2, "c", "A"), ("label", 1, None, "Profit for the year"), ("label", 2, None, "Net cash flows from operating activities"), ("label", 3, None, "Total investing")])
    others = t(schema, [("one", 7, "x", "Turnover"), ("concept", 4, "c", "B"), ("concept", 5, "c", "B"), ("concept", 6, "e", "A"), ("label", 2, None, "Net cash from operating activities"), ("label", 3, None, "Profit for the period"), ("label", 4, None, "Cash generated")])
    return periods.counterparts(lines, others, ["k"])


# Breakdowns -------------------------------------------------------------------------------------------------------------

_MEMBERS = "g string, item string, value double, total double"


def _members(g, total, **values):
    return [(g, k, v, total) for k, v in values.items()]


@scenario("g string, item string", [("sums", "hyperscale"), ("sums", "aiclouds"), ("sums", "edge"), *[("plain", k) for k in ("iphone", "services", "mac", "wearables", "ipad")], ("none", "a"), ("none", "b")])
def remove_subtotals(t):
    rows = _members("sums", 96221, datacenter=89023, hyperscale=48710, aiclouds=40313, edge=7198) + _members("plain", 109417, iphone=54252, services=30739, mac=10352, wearables=7883, ipad=6191) + _members("none", None, a=1, b=2)
    return breakdowns.remove_subtotals(t(_MEMBERS, rows), ["g"], "item", "value", "total")


@scenario("g string, item string", [*[("regions", k) for k in ("uscanada", "europe", "asiapacific", "rest")], *[("short", k) for k in "abc"]])
def drop_overlaps(t):
    rows = _members("regions", 200966, uscanada=78866, europe=46569, asiapacific=53817, rest=21714, us=74780) + _members("short", 100, a=60, b=30, c=5)
    return breakdowns.drop_overlaps(t(_MEMBERS, rows), ["g"], "item", "value", "total")


@scenario("g string, item string, fine boolean, coarse boolean", [
    *[("both", k, k not in ("product", "service"), k in ("product", "service")) for k in ("product", "service", "server", "office", "gaming", "linkedin", "other")],
    *[("regions", k, k != "americas", k in ("americas", "emea", "apac")) for k in ("us", "otheramericas", "americas", "emea", "apac")],
    *[("countries", k, k not in ("americas", "asia", "emea"), k in ("americas", "asia", "emea")) for k in ("americas", "asia", "emea", "gb", "jp", "otheramericas", "otherasia", "othereurope", "us")],
    *[("one", k, True, False) for k in "abcd"],
])
def two_partitions(t):
    rows = _members("both", 332, product=64, service=268, server=129, office=111, gaming=22, linkedin=20, other=50) + _members("regions", 23769, us=12529, otheramericas=1591, americas=14120, emea=6289, apac=3360)
    rows += _members("countries", 12868, americas=7454, asia=2014, emea=3400, gb=880, jp=893, otheramericas=708, otherasia=1121, othereurope=2520, us=6746) + _members("one", 10, a=1, b=2, c=3, d=4)
    return breakdowns.two_partitions(t(_MEMBERS, rows), ["g"], "item", "value", "total")


@scenario("item string, parent string", [("search", "properties"), ("youtube", "properties"), ("properties", "advertising"), ("network", "advertising"), ("advertising", "google"), ("cloud", "google"), ("other", "google")])
def subtotal_tree(t):
    leaves = ("search", "youtube", "network", "cloud", "other")
    rows = {"search": 26338, "youtube": 5037, "properties": 31375, "network": 5720, "advertising": 37095, "cloud": 3444, "other": 5478, "stray": 12345}
    table = t("g string, item string, value double, leaf boolean, root string", [("g", k, v, k in leaves, "google") for k, v in rows.items()])
    return breakdowns.subtotal_tree(table, ["g"], "item", "value", "leaf", "root")


@scenario("g string, item string, value double", [("needs", "a", 80), ("needs", "b", 30), ("needs", "elimination", -10), ("fits", "a", 70), ("fits", "b", 30), ("neither", "a", 50)])
def with_eliminations(t):
    schema = "g string, item string, value double"
    members = t(schema, [("needs", "a", 80), ("needs", "b", 30), ("fits", "a", 70), ("fits", "b", 30), ("neither", "a", 50)])
    items = t(schema, [("needs", "elimination", -10), ("fits", "elimination", -10), ("neither", "elimination", -10)])
    return breakdowns.with_eliminations(members, items, t("g string, total double", [("needs", 100), ("fits", 100), ("neither", 100)]), ["g"], "item", "value", "total")


@scenario("g string, item string, value double", [("y", "search", 60), ("y", "ads", 20), ("y", "cloud", 20)])
def completed_by_segments(t):
    split = t("g string, segment string, item string, value double", [("y", "google", "search", 60), ("y", "google", "ads", 20), ("z", "google", "search", 50)])
    segments = t("g string, item string, value double", [("y", "google", 80), ("y", "cloud", 20), ("z", "google", 80), ("z", "cloud", 20)])
    return breakdowns.completed_by_segments(split, segments, t("g string, total double", [("y", 100), ("z", 100)]), ["g"], "segment", "item", "value", "total")


@scenario("g string, gap double, concept string", [("a", 10, "HedgingGains")])
def gap_names(t):
    gaps = t("g string, gap double", [("a", 10), ("b", 5)])
    facts = t("g string, concept string, value double", [("a", "HedgingGains", 10.0004), ("a", "Other", 12), ("b", "X", 5), ("b", "Y", 5)])
    return breakdowns.gap_names(gaps, facts, ["g"], "gap", "concept", "value")


@scenario("grp string, regional boolean", [("segments", True), ("geography", True), ("amazon", False), ("rest", False)])
def regional_views(t):
    rows = [("segments", k) for k in ("americas", "europe", "greaterchina", "japan", "restofasiapacific")] + [("geography", k) for k in ("us", "china", "othercountries")] + [("amazon", k) for k in ("northamerica", "international", "aws")] + [("rest", "other")]
    return breakdowns.regional_views(t("grp string, item string", rows), [], "grp", "item")


@scenario("r string, basis string, currency string", [("a", "IFRS", "EUR"), ("b", "US GAAP", "USD"), ("c", None, None)])
def report_basis(t):
    rows = [("a", "ifrs-full:Revenue", "EUR"), ("a", "us-gaap:Revenues", "EUR"), ("a", "x:Y", "USD"), ("b", "us-gaap_Revenues", "USD"), ("b", "x:Y", None), ("c", "x:Y", None)]
    return breakdowns.report_basis(t("r string, concept string, currency string", rows), ["r"], "concept", "currency")


@scenario("g string, item string, value double", [("a", "x", 60), ("a", "y", 40)])
def chosen_rows(t):
    schema = "g string, item string, value double"
    candidates = t(schema, [("a", "x", 60), ("a", "y", 40), ("a", "z", 7), ("b", "x", 60), ("b", "y", 10), ("c", "x", 100)])
    chosen = t("g string, item string", [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x")])
    return breakdowns.chosen_rows(candidates, chosen, t("g string, total double", [("a", 100), ("b", 100), ("c", 100)]), ["g"], "item", "value", "total")


@scenario("g string, split string, common long", [("a", "products", 2), ("b", "one", 1)])
def continuing_split(t):
    splits = t("g string, split string, item string", [("a", "products", "x"), ("a", "products", "y"), ("a", "countries", "us"), ("a", "countries", "x"), ("b", "one", "x"), ("b", "two", "x")])
    return breakdowns.continuing_split(splits, t("g string, item string", [("a", "x"), ("a", "y"), ("b", "x"), ("b", "x")]), ["g"], "split", "item")


@scenario("id int, level boolean, axes string", [(1, True, "product"), (2, False, "product,segment"), (3, True, "")])
def neutral_removed(t):
    rows = [(1, {"product": "a", "consolidation": "OperatingSegmentsMember"}), (2, {"product": "a", "segment": "b"}), (3, {"consolidation": "OperatingSegmentsMember"})]
    out = breakdowns.neutral_removed(t("id int, dims map<string,string>", rows), ["OperatingSegmentsMember"])
    return out.select("id", F.col("segment_level").alias("level"), F.array_join(F.array_sort(F.map_keys("dims")), ",").alias("axes"))


@scenario("g string, item string", [("a", "health"), ("a", "rx"), ("a", "insurance"), *[("b", k) for k in ("product", "service", "p1", "p2", "s1", "s2")]])
def declared_parents(t):
    members = _members("a", 300, optum=150, health=120, rx=60, insurance=150) + _members("b", 100, product=60, service=40, p1=30, p2=30, s1=20, s2=20)
    edges = t("ancestor string, node string", [("optum", "health"), ("optum", "rx"), ("product", "p1"), ("product", "p2"), ("service", "s1"), ("service", "s2")])
    return breakdowns.declared_parents_dropped(t(_MEMBERS, members), edges, ["g"], "item", "value", "total")
