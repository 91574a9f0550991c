"""Lists, statements and filing lists over small literal tables, beside the rows that have to come out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import lists, statements
from ledgerloom.sources import filings, listing
from . import scenarios
from .scenarios import scenario

_before = set(scenarios.QUERIES)
d, c = dt.date, F.col

# Lists ------------------------------------------------------------------------------------------------------------------


@scenario("g string, key string, total string", [("a", "x", None), ("b", "x", "t"), ("b", "t", "t")])
def for_period(t):
    items = t("g string, key string, total string, since date, until date", [("a", "x", "t", None, None), ("a", "t", "t", d(2024, 1, 1), None), ("b", "x", "t", d(2023, 1, 8), d(2030, 1, 1)), ("b", "t", "t", None, None), ("b", "y", "t", None, d(2022, 12, 1))])
    return lists.for_period(items, ["g"], F.lit(d(2022, 12, 31)), "total")


@scenario("id int", [(2,), (4,)])
def outside_windows(t):
    values = t("k string, id int, day date, status string", [("a", 1, d(2023, 3, 31), "verified"), ("a", 2, d(2019, 3, 31), "verified"), ("a", 3, d(2019, 3, 31), "rejected"), ("b", 4, d(2025, 3, 31), "held"), ("z", 5, d(1990, 1, 1), "held")])
    return lists.outside_windows(values, t("k string, since date, until date", [("a", d(2020, 1, 1), None), ("b", None, d(2024, 1, 1))]), ["k"], "day", "status")


@scenario("g string, k string, reason string", [("a", "y", "retired")])
def left_out(t):
    return lists.left_out(t("g string, k string", [("a", "x"), ("a", "y")]), t("g string, k string", [("a", "x"), ("b", "y")]), ["g", "k"], "retired")


@scenario("g string, label string, why string", [("retail", "Power Generation", "new"), ("retail", "Mining", "new"), (None, "Rail", "old")])
def merged_left_out(t):
    schema = "g string, label string, why string"
    new = t(schema, [("retail", "Power Generation", "new"), ("retail", "Mining", "new"), ("revenue", "power-generation", "new"), (None, "Mines", "new")])
    old = t(schema, [("retail", "mining", "old"), (None, "Rail", "old")])
    return lists.merged_left_out(new, old, t("g string, label string", [("revenue", "Power Generation"), ("revenue", "Mines")]), "g", "label")


@scenario("s string, label string", [("a", "two"), ("a", "one"), ("b", "x")])
def limited_additions(t):
    rows = [("a", "one", False, 1), ("a", "two", True, 2), ("a", "three", False, 3), ("b", "x", False, 1)]
    return lists.limited(t("s string, label string, has boolean, o int", rows), ["s"], "has", [c("o")], 2)


@scenario("g string, k string", [*[("ops", k) for k in ("m0", "m1")], *[("geo", f"g{i}") for i in range(4)], *[("more", k) for k in ("n0", "n1")]])
def capped_list(t):
    rows = [("s", "ops", f"m{i}", i, "metric") for i in range(4)] + [("s", "geo", f"g{i}", 10 + i, "revenue_breakdown") for i in range(4)] + [("s", "more", f"n{i}", 20 + i, "metric") for i in range(3)]
    return lists.capped_list(t("s string, g string, k string, o int, kind string", rows), ["s"], "g", "o", "kind", 8, 2)


@scenario("g string, k string", [("mix", "a"), ("ops", "x"), ("ops", "z"), ("solo", "only")])
def maintained_list(t):
    schema = "s string, g string, k string, unit string, kind string"
    items = t(schema, [("s", "mix", "a", "percent", "mix"), ("s", "ops", "x", "count", "metric"), ("s", "ops", "y", "count", "metric"), ("s", "solo", "only", "count", "metric")])
    add = t("s string, g string, k string, unit string", [("s", "mix", "b", "currency"), ("s", "ops", "z", "currency"), ("s", "ops", "x", "count"), ("s", "none", "q", "count")])
    return lists.maintained(items, add, t("s string, g string, k string", [("s", "ops", "y"), ("s", "solo", "only")]), ["s"], "g", "k")


@scenario("g string", [("apps",)])
def repeats_tagged(t):
    groups = [("s", "apps", "family", True), ("s", "apps", "labs", True), ("s", "growth", "family", False), ("s", "growth", "labs", False), ("s", "new", "family", True), ("s", "new", "other", True), ("s", "lone", "family", True)]
    return lists.repeats(t("s string, g string, k string, amount boolean", groups), t("s string, breakdown string, k string", [("s", "segments", "family"), ("s", "segments", "labs"), ("s", "geo", "us")]), ["s"], "g", "k")


@scenario("k string", [("old",), ("never",)])
def long_absent(t):
    values = t("s string, k string, day date", [("s", "now", d(2025, 9, 30)), ("s", "old", d(2024, 3, 31)), ("s", "spring", d(2025, 3, 31))])
    return lists.long_absent(t("s string, k string", [("s", k) for k in ("now", "old", "spring", "never")]), values, ["s"], "k", "day", 4)


@scenario("s string, current long, named long, from_xbrl long, kept long, fresh long, recall double, precision double", [("a", 3, 1, 1, 2, 3, 0.666667, 0.666667)])
def list_score(t):
    owner = t("s string, label string, current boolean", [("a", "Net Sales", True), ("a", "Cloud", True), ("a", "Users", True), ("a", "Stores", False)])
    fresh = t("s string, label string", [("a", "net sales"), ("a", "Stores"), ("a", "Headcount")])
    return lists.list_score(owner, fresh, t("s string, label string", [("a", "cloud")]), ["s"], "label")


@scenario("f string", [("new",), ("again",)])
def pending_filings(t):
    log = t("f string, status string, attempts int", [("done", "processed", 1), ("again", "failed", 1), ("gone", "failed", 3)])
    return lists.pending(t("f string", [("new",), ("done",), ("again",), ("gone",)]), log, ["f"], ["processed"], 3)


@scenario("f string, version int", [("a", 2), ("b", 1), ("c", 0)])
def carried_filings(t):
    return lists.carried(t("f string, version int", [("a", 1), ("b", 1), ("c", 0)]), ["f"], 1, 2, t("f string", [("b",)]))


@scenario("f string, k string, status string, value double", [("f1", "a", "verified", 2), ("f1", "b", "rejected", 1), ("f1", "c", "verified", 9), ("f2", "a", "verified", 5), ("f3", "a", "held", 7)])
def recorded_reading(t):
    schema = "f string, group_key string, k string, status string, value double"
    stored = t(schema, [("f1", "g", "a", "verified", 1), ("f1", "g", "b", "verified", 1), ("f1", "unread", "c", "verified", 9), ("f2", "g", "a", "verified", 5), ("f3", "g", "a", "held", 7)])
    reading = t(schema, [("f1", "g", "a", "verified", 2), ("f3", "g", "b", "verified", 8)])
    return lists.recorded(stored, reading, t("f string", [("f1",)]), ["f", "group_key", "k"], "f", t("f string, group_key string", [("f1", "unread")]))


@scenario("k string, n long", [("a", 5), ("b", 2)])
def tallies(t):
    return lists.tallies([t("k string, n int", [("a", 2), ("b", 2)]), t("k string, n int", [("a", 3)])], ["k"], "n")


@scenario("s string, values long, verified long, share double, reason string, n long", [("a", 4, 1, 0.25, "scale", 2), ("a", 4, 1, 0.25, "period", 1), ("b", 1, 1, 1, None, None)])
def trial_summary(t):
    rows = [("a", "verified", None), ("a", "held", "scale"), ("a", "held", "scale"), ("a", "held", "period"), ("b", "verified", None)]
    return lists.trial_summary(t("s string, status string, reason string", rows), ["s"], "status", "reason")


@scenario("g string, title string", [("a", "Rule"), ("b", "Stored"), ("c", "Proposed"), ("z", None)])
def breakdown_titles(t):
    rule = t("g string, rule string", [("a", "Rule"), ("b", None), ("c", None), ("z", None)])
    return lists.titled(rule, t("g string, title string", [("a", "P"), ("b", "P"), ("c", "Proposed")]), t("g string, title string", [("a", "S"), ("b", "Stored")]), ["g"])


_RULES = [("scale", "whole", "scale not stated"), ("jump", "start", "changed "), ("reread", "within", "a new reading"), ("place", "pattern", "^no such .* place$")]


@scenario("id int, codes string, only_holds boolean", [(0, "scale,jump", True), (1, "scale,text", False), (2, "reread", False), (3, "place", False), (4, "", False)])
def note_reasons(t):
    notes = [["scale not stated", "changed 1.9x in a quarter"], ["scale not stated", "hello"], ["see: a new reading differs"], ["no such known place"], []]
    codes = lists.reasons_of(c("notes"), _RULES)
    return t("id int, notes array<string>", list(enumerate(notes))).select("id", F.array_join(F.transform(codes, lambda x: F.coalesce(x, F.lit("text"))), ",").alias("codes"), lists.only_reasons(codes, ["scale", "jump"], ["reread"]).alias("only_holds"))


# Statements -------------------------------------------------------------------------------------------------------------


@scenario("concept string, dims string, instant boolean, value double", [("Revenue", "", False, 100), ("Backlog", "", True, 50), ("Backlog", "seg=a", True, 20), ("Timed", "", True, 8)])
def quarter_facts(t):
    q, e = d(2026, 4, 1), d(2026, 6, 30)
    rows = [("f", "Revenue", {}, q, e, 100), ("f", "Revenue", {}, d(2026, 1, 1), e, 210), ("f", "Backlog", {}, None, e, 50), ("f", "Backlog", {"TimingAxis": "2027"}, None, e, 30), ("f", "Backlog", {"seg": "a"}, None, e, 20), ("f", "Timed", {"TimingAxis": "2027"}, None, e, 8), ("f", "Backlog", {}, None, d(2026, 3, 31), 44), ("f", "X", {"MeasurementInputAxis": "rate"}, None, e, 5)]
    return statements.quarter_facts(t("filing string, concept string, dims map<string,string>, start date, end date, value double", rows), F.lit(e))


@scenario("filing string, finish date", [("f", d(2025, 6, 28)), ("g", d(2025, 6, 30))])
def year_ago_end(t):
    rows = [("f", d(2025, 6, 28)), ("f", d(2026, 6, 27)), ("f", d(2025, 6, 24)), ("g", d(2025, 6, 30)), ("h", d(2025, 3, 31))]
    facts = t("filing string, end date", rows)
    out = statements.year_ago_end(facts, F.when(c("filing") == "g", F.lit(d(2026, 6, 30))).otherwise(F.lit(d(2026, 6, 27))))
    return out.withColumnRenamed("end", "finish")


@scenario("concept string, value double", [("Cash", 10)])
def consolidated_only(t):
    rows = [("Cash", {}, 10), ("Cash", {"vie": "x"}, 3), ("Part", {"vie": "x"}, 4)]
    return statements.consolidated(t("concept string, dims map<string,string>, value double", rows), ["concept"])


@scenario("o int, label string", [(1, "Assets"), (2, "Current"), (3, "Cash"), (6, "Equity")])
def headings_pruned(t):
    rows = [("s", 1, "Assets", 0, True), ("s", 2, "Current", 1, True), ("s", 3, "Cash", 2, False), ("s", 4, "Other assets", 1, True), ("s", 5, "Liabilities", 0, True), ("s", 6, "Equity", 0, False)]
    return statements.headings_pruned(t("s string, o int, label string, level int, heading boolean", rows), ["s"], "o", "level", "heading")


@scenario("s string, period string, p int, label string, value double", [
    ("f", "duration_2024-01-01_2024-12-31", 1, "Net income", 7), ("f", "duration_2024-01-01_2024-12-31", 2, "Dividends", -3), ("f", "duration_2024-01-01_2024-12-31", 3, "Cash, beginning", 10), ("f", "duration_2024-01-01_2024-12-31", 4, "Cash, end", 14),
])
def presented_column(t):
    lines = t("s string, position int, concept string, label string, sign double, balance string", [("f", 1, "NI", "Net income", None, None), ("f", 2, "Div", "Dividends", -1, None), ("f", 3, "Cash", "Cash, beginning", None, "opening"), ("f", 4, "Cash", "Cash, end", None, "closing"), ("f", 5, "None", "Not reported", None, None)])
    a, e = d(2024, 1, 1), d(2024, 12, 31)
    facts = t("s string, concept string, start date, end date, value double", [("f", "NI", a, e, 7), ("f", "Div", a, e, 3), ("f", "Cash", None, d(2023, 12, 29), 10), ("f", "Cash", None, e, 14), ("f", "Cash", None, d(2023, 12, 20), 9)])
    return statements.presented_column(lines, facts, ["s"]).withColumnRenamed("position", "p")


@scenario("id int, cells string", [(0, "Sales||$1,234||(5)|"), (1, "Margin|53.7%|"), (2, "($|x"), (3, "a||($12)%||"), (4, "")])
def folded_symbols(t):
    rows = [["Sales", "$", "1,234", "(", "5", ")"], ["Margin", "53.7", "%"], ["($", "x"], ["a", "($", "12", ")", "%"], []]
    return t("id int, r array<string>", list(enumerate(rows))).select("id", F.array_join(statements.folded_symbols(c("r")), "|").alias("cells"))


@scenario("k int, grp int", [(2, 1), (3, 1), (6, 2)])
def figure_columns(t):
    rows = [("t", r, k, x) for r, line in enumerate([{0: "", 2: "2025", 6: "2024"}, {0: "Sales", 3: "1,234", 6: "999"}, {0: "Cost", 2: "(5)", 6: "7"}, {0: "Gross", 3: "8", 6: "9", 9: "1"}, {0: "Tax", 2: "1", 6: "2"}]) for k, x in line.items()]
    out = statements.figure_columns(t("t string, r int, k int, x string", rows).where("r > 0 OR k = 0"), ["t"], "r", "k", "x")
    return out.withColumnRenamed("group", "grp")


_BS = [["", "2025", "2024"], ["Cash", "1", "2"], ["Plant", "3", "4"], ["Debt", "2", "3"], ["Equity", "2", "3"]]


@scenario("o int, kind string, head int", [(1, "balance", 1), (2, "balance", 1), (4, "income", 4)])
def found_statements(t):
    tables = [("f", 0, "Selected balance sheet data", _BS), ("f", 1, "CONSOLIDATED BALANCE SHEETS (in millions)", _BS), ("f", 2, "", _BS), ("f", 3, "Maturities of debt by year", _BS[:3]), ("f", 4, "", [["Consolidated Statements of Operations", "", ""], *_BS]), ("f", 5, "Reconciliation of statements of income", _BS), ("f", 6, "balance sheets", [["Three months ended", "", ""], *_BS])]
    out = statements.found_statements(t("f string, o int, context string, rows array<array<string>>", tables), ["f"], "o")
    return out.withColumnRenamed("first", "head")


@scenario("p int, label string, is_heading boolean, period_end date, value double", [(1, "Current assets:", True, d(2025, 12, 31), None), (1, "Current assets:", True, d(2024, 12, 31), None), (2, "Cash", False, d(2025, 12, 31), 10), (2, "Cash", False, d(2024, 12, 31), 8), (3, "Debt", False, d(2025, 12, 31), -5)])
def printed_lines(t):
    tables = t("f string, rows array<array<string>>", [("f", [["", "2025", "2024"], ["Current assets:", "", ""], ["Cash", "10", "8"], ["Debt", "(5)", ""]])])
    columns = t("f string, col int, period_end date", [("f", 1, d(2025, 12, 31)), ("f", 2, d(2024, 12, 31))])
    return statements.printed_lines(tables, ["f"], columns).withColumnRenamed("position", "p").where("p > 0")


@scenario("label string, y int, value double", [(k, y, v) for k, vs in (("Revenue", (5, 4, 3)), ("Net income", (2, 1, 1)), ("Total assets", (9, 8, 7))) for y, v in zip((2025, 2024, 2023), vs)])
def summary_figures(t):
    rows = [["", "2025", "2024", "2023"], ["Revenue", "5", "4", "3"], ["Net income", "2", "1", "1"], ["Total assets", "9", "8", "7"], ["Employees", "n/a", "1", "2"]]
    tables = t("f string, context string, rows array<array<string>>", [("f", "Selected Financial Data", rows), ("g", "Segment data", rows), ("h", "Five-year summary", rows[:2])])
    return statements.summary_figures(tables, ["f"]).withColumnRenamed("year", "y")


@scenario("id int, day date, apart boolean", [(1, d(2023, 12, 30), False), (2, d(2023, 12, 30), False), (3, d(2023, 12, 15), True)])
def aligned_dates(t):
    rows = [("k", 1, d(2023, 12, 30), d(2024, 2, 1), True), ("k", 2, d(2023, 12, 31), d(2025, 2, 1), False), ("k", 3, d(2023, 12, 15), d(2025, 3, 1), False)]
    return statements.aligned_dates(t("k string, id int, day date, filed date, own boolean", rows), ["k"], "day", c("own"))


@scenario("y int, codes string", [(2000, "TWD,USD"), (2001, "USD"), (2002, "USD"), (2005, "EUR")])
def currencies_of_years(t):
    rows = [("k", 2000, "TWD"), ("k", 2001, "USD"), ("k", 2002, "USD"), ("k", 2005, "EUR")]
    out = statements.currencies_of_years(t("k string, y int, cur string", rows), ["k"], "y", "cur")
    return out.withColumn("codes", F.array_join("currencies", ","))


@scenario("y int, basis string", [(2000, "GAAP"), (2001, "GAAP"), (2003, "IFRS"), (2004, "IFRS"), (2002, "GAAP")])
def filled_basis(t):
    return statements.filled_basis(t("k string, y int, basis string", [("k", 2000, None), ("k", 2001, "GAAP"), ("k", 2002, None), ("k", 2003, "IFRS"), ("k", 2004, None)]), ["k"], "y", "basis")


@scenario("o int, auditor string", [(2, None), (5, "KPMG"), (9, "EY")])
def audited_by(t):
    return statements.audited_by(t("f string, o int", [("f", 2), ("f", 5), ("f", 9)]), t("f string, o int, auditor string", [("f", 3, "KPMG"), ("f", 7, "EY")]), ["f"], "o", "auditor")


@scenario("id int, year_offset int", [(1, -1), (2, 0), (3, 1)])
def named_by_votes(t):
    votes = [("k", "0201", 2025, True, d(2026, 2, 1), d(2026, 2, 1)), ("k", "0201", 2025, False, d(2025, 11, 1), d(2026, 2, 1)), ("k", "1231", 2027, False, d(2026, 7, 26), d(2026, 12, 31)), ("k", "1231", 2026, False, d(2026, 4, 26), d(2026, 12, 31))]
    periods = t("k string, id int, mmdd string", [("k", 1, "0201"), ("k", 2, "0630"), ("k", 3, "1231")])
    return statements.named_by_votes(periods, t("k string, mmdd string, reported_year int, annual boolean, day date, nominal date", votes), ["k"], "day", "nominal")


@scenario("id int, start date", [(1, d(2003, 4, 1)), (2, d(2003, 1, 1)), (3, d(2004, 4, 1)), (4, d(2004, 1, 1))])
def mended_starts(t):
    rows = [("h", 1, d(2003, 1, 4), d(2003, 6, 30)), ("h", 2, d(2003, 1, 1), d(2003, 6, 30)), ("h", 3, d(2004, 4, 1), d(2004, 6, 30)), ("h", 4, d(2004, 1, 1), d(2004, 6, 30))]
    return statements.mended_starts(t("h string, id int, start date, end date", rows), ["h"])


@scenario("k int, x string", [(0, ""), (1, "2025"), (2, "2025"), (3, "2024"), (4, "2024")])
def spanned_headings(t):
    return statements.spanned_headings(t("r int, k int, x string", [(1, 0, ""), (1, 1, "2025"), (1, 2, ""), (1, 3, "2024"), (1, 4, " ")]), ["r"], "k", "x")


@scenario("k int", [(1,)])
def rate_columns(t):
    rows = [(1, x) for x in ("5.25", "4.10", "3.99", "120")] + [(2, x) for x in ("1,234", "5.5", "999")] + [(3, x) for x in ("5.25", "4.10")]
    return statements.rate_columns(t("k int, x string", rows), ["k"], "x")


@scenario("r int, a int, b int", [(9, 2, 4)])
def adjacent_sums(t):
    rows = [("t", 1, 50), ("t", 2, 11), ("t", 3, -1), ("t", 4, 204), ("t", 9, 214), ("t", 11, 7)]
    out = statements.adjacent_sums(t("t string, r int, v double", rows).withColumn("u", F.lit(1.0)), ["t"], "r", "v", "u")
    return out.withColumnsRenamed({"first": "a", "last": "b"}).where("a = 2")


@scenario("o int, head int", [(4, 2), (7, 5)])
def subtotal_blocks(t):
    rows = [("s", 1, 500), ("s", 2, 10), ("s", 3, 20), ("s", 4, 30), ("s", 5, 7), ("s", 6, 8), ("s", 7, 15), ("s", 8, 99)]
    return statements.subtotal_blocks(t("s string, o int, v double", rows), ["s"], "o", "v").withColumnRenamed("first", "head")


@scenario("f string", [("b",)])
def reports_without(t):
    return statements.without(t("f string, k string", [("a", "income"), ("b", "income")]), t("f string, k string", [("a", "revenue"), ("c", "revenue")]), ["f"])


# Filing lists -----------------------------------------------------------------------------------------------------------


@scenario("url string, allowed boolean", [("https://www.sec.gov/x", True), ("https://evil.example/x", False), (None, False)])
def allowed_url(t):
    return t("url string", [("https://www.sec.gov/x",), ("https://evil.example/x",), (None,)]).select("url", listing.allowed_url(c("url"), ["https://www.sec.gov/", "https://opendart.fss.or.kr/"]).alias("allowed"))


@scenario("cik int, ends string", [(1, "2024-05-12,2025-05-11")])
def report_period_ends(t):
    out = listing.period_ends(t("cik int, report_date date", [(1, d(2025, 5, 11)), (1, d(2024, 5, 12)), (1, None), (1, d(2025, 5, 11))]), ["cik"])
    return out.withColumn("ends", F.array_join(c("ends").cast("array<string>"), ","))


_F = "cik string, accession string, form string, filed date"


@scenario("cik string, accession string", [("new", "n1"), ("new", "o1"), ("old", "o1"), ("old", "o2")])
def all_era_reports(t):
    rows = [("new", "n0", "8-K", d(2010, 1, 1)), ("new", "n1", "10-K", d(2011, 1, 1)), ("old", "o1", "10-K405", d(1999, 1, 1)), ("old", "o2", "10-Q", d(2012, 1, 1)), ("old", "o3", "10-K/A", d(1999, 5, 1))]
    return listing.all_reports(t(_F, rows), t("predecessor string, cik string", [("old", "new")]), "cik")


@scenario("accession string, form string", [("a", "6-K"), ("b", "6-K")])
def tagged_interims(t):
    rows = [("c", "a", "6-K", d(2024, 1, 1), True), ("c", "b", "6-K/A", d(2024, 1, 1), True), ("c", "x", "6-K", d(2024, 1, 1), False), ("c", "y", "20-F", d(2024, 1, 1), True)]
    return listing.tagged_interims(t(_F + ", is_xbrl boolean", rows))


@scenario("accession string, quarter_end date", [("a", d(2024, 3, 31)), ("b", d(2024, 6, 30))])
def release_listing(t):
    rows = [("c", "a", "6-K", d(2024, 4, 18)), ("c", "b", "6-K", d(2024, 9, 30)), ("c", "9999999997-24", "6-K", d(2024, 4, 18)), ("c", "x", "20-F", d(2024, 4, 18))]
    return listing.releases(t(_F, rows), t("cik string, mmdd string", [("c", "1231")]), "cik")


@scenario("accession string, quarter_end date, confirmed boolean", [("a", d(2024, 3, 31), True), ("c", d(2024, 6, 30), False), ("f", d(2024, 3, 31), False), ("late", d(2024, 9, 30), True)])
def earnings_candidates(t):
    rows = [("us", "a", "8-K", d(2024, 4, 25), "2.02,9.01"), ("us", "b", "8-K", d(2024, 4, 26), "7.01"), ("us", "c", "8-K", d(2024, 7, 25), "8.01"), ("us", "late", "8-K", d(2024, 12, 20), "2.02"), ("tw", "f", "6-K", d(2024, 4, 18), None), ("tw", "g", "6-K", d(2024, 6, 28), None), ("tw", "h", "8-K", d(2024, 4, 18), None)]
    profiles = t("cik string, mmdd string, is_foreign boolean, ends array<date>", [("us", "1231", False, None), ("tw", "1231", True, None)])
    return listing.earnings_candidates(t(_F + ", items string", rows), profiles, "cik")


@scenario("cik string, accession string", [("spx", "new")])
def ipo_prospectus(t):
    rows = [("spx", "old", "424B4", d(2026, 5, 1)), ("spx", "new", "424B4", d(2026, 6, 1)), ("spx", "late", "424B4", d(2026, 9, 1)), ("ibm", "x", "424B1", d(1990, 1, 1))]
    return listing.prospectus(t(_F, rows), t("cik string, first_report date", [("spx", d(2026, 8, 1)), ("ibm", d(1990, 3, 1))]), "cik", F.lit(d(2026, 11, 1)))


_REPORTS = [("amzn", f, x, "1231", None) for f, x in (("10-Q", d(2015, 10, 23)), ("10-K", d(2016, 1, 29)), ("10-Q", d(2016, 4, 29)), ("10-Q", d(2016, 7, 29)), ("10-Q", d(2016, 10, 28)))]
_REPORTS += [("aapl", f, x, "0924", None) for f, x in (("10-K", d(2015, 10, 28)), ("10-Q", d(2016, 1, 27)), ("10-Q", d(2016, 4, 27)), ("10-Q", d(2016, 7, 27)))] + [("none", "10-Q", x, None, None) for x in (d(2016, 4, 29), d(2016, 7, 29))]


@scenario("cik string, filed date", [("amzn", d(2016, 4, 29)), ("amzn", d(2016, 7, 29)), ("amzn", d(2016, 10, 28)), ("aapl", d(2016, 1, 27)), ("aapl", d(2016, 4, 27)), ("aapl", d(2016, 7, 27)), ("none", d(2016, 7, 29))])
def first_fiscal_year(t):
    return listing.first_year(t("cik string, form string, filed date, mmdd string, period_end date", _REPORTS), "cik", F.lit(d(2016, 5, 15)))


@scenario("f string, o int", [("a", 1), ("a", 3)])
def printed_documents(t):
    return listing.printed_documents(t("f string, o int, document_type string", [("a", 1, "10-K"), ("a", 2, "EX-10.1"), ("a", 3, "ex-13"), ("a", 4, "GRAPHIC")]))


@scenario("f string, o int", [("a", 2), ("a", 3), ("b", 1), ("b", 3)])
def release_documents(t):
    rows = [("a", 1, "6-K"), ("a", 2, "EX-99.1"), ("a", 3, "EX-99.2"), ("b", 1, "6-K"), ("b", 2, "EX-10.4"), ("b", 3, "EX-1"), ("b", 4, "6-K")]
    return listing.release_documents(t("f string, o int, document_type string", rows), "f", "o")


@scenario("cik int, id int", [(1, 2), (1, 3)])
def fresh_lists(t):
    rows = [(1, 1, dt.datetime(2026, 1, 1, 10), None), (1, 2, dt.datetime(2026, 1, 1, 11), None), (1, 3, dt.datetime(2020, 1, 1), "part1"), (2, 4, dt.datetime(2026, 1, 1, 9), None)]
    return listing.fresh_lists(t("cik int, id int, taken timestamp, part string", rows), "cik", "taken", F.lit(dt.datetime(2026, 1, 1, 12)))


@scenario("element string, depth int, place int", [("Assets", 0, 1), ("Current", 1, 2), ("Cash", 2, 3), ("Receivables", 2, 4), ("Noncurrent", 1, 5), ("Plant", 2, 6)])
def role_order(t):
    arcs = [("r", "Assets", "Noncurrent", 20), ("r", "Assets", "Current", 10), ("r", "Current", "Receivables", 2), ("r", "Current", "Cash", 1), ("r", "Noncurrent", "Plant", 1)]
    return listing.role_order(t("r string, parent string, child string, order double", arcs), "r").withColumnRenamed("position", "place")


@scenario("k string, body string", [("a", "fresh"), ("b", "kept"), ("c", "fresh")])
def kept_copy(t):
    return filings.kept_or_fresh(t("k string, body string", [("a", "fresh"), ("c", "fresh"), ("b", None)]), t("k string, body string", [("a", "kept"), ("b", "kept")]), ["k"], "body")


@scenario("accession string", [("a",), ("b",)])
def periodic_reports(t):
    rows = [("a", "10-Q", d(2024, 5, 1)), ("b", "20-F", d(2024, 5, 1)), ("c", "10-K/A", d(2024, 5, 1)), ("d", "10-K", d(2019, 5, 1))]
    return filings.periodic(t("accession string, form string, filingDate date", rows), F.lit(d(2020, 1, 1)))


QUERIES = {k: scenarios.QUERIES[k] for k in scenarios.QUERIES if k not in _before}
SQL = {k: scenarios.SQL[k] for k in QUERIES}
