"""Identity of series, proofs, checks and choices over small literal tables, beside the rows that have to come out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import checks, identity, proofs, selection
from . import scenarios
from .scenarios import scenario

_before = set(scenarios.QUERIES)
d, c = dt.date, F.col

# Identity ---------------------------------------------------------------------------------------------------------------


@scenario("g string, target string", [("x_market", "products")])
def joined_axes(t):
    schema = "y int, g string, item string, value double"
    own = t(schema, [(2017, "x_market", "a", 1), (2017, "x_market", "b", 2), (2018, "x_market", "a", 3), (2018, "x_other", "a", 9), (2018, "x_other", "b", 4), (2018, "x_lone", "a", 3)])
    standard = t(schema, [(2018, "products", "a", 3), (2018, "products", "b", 4), (2019, "products", "c", 4)])
    return identity.joined_axes(own, standard, ["y"], "g", "item", "value")


@scenario("q string, item string, target string", [("2018Q2", "members", "network")])
def merged_duplicates(t):
    rows = [("2018Q2", "members", 4825, False), ("2018Q2", "network", 4825, True), ("2018Q2", "sites", 9, False), ("2018Q2", "one", 7, False), ("2018Q2", "two", 7, False), ("2018Q2", "seven", 7, True), ("2018Q3", "members", 5, False), ("2018Q3", "network", 6, True)]
    return identity.merged_duplicates(t("q string, item string, value double, later boolean", rows), ["q"], "item", "value", "later")


@scenario("y int, p string, item string, target string", [(2018, "Q1", "googleother", "devices")])
def year_remainders(t):
    rows = [(2018, p, k, True) for p in ("Q2", "Q3", "FY") for k in ("properties", "network", "devices")] + [(2018, "FY", "advertising", True)]
    rows += [(2018, "Q1", "properties", True), (2018, "Q1", "network", True), (2018, "Q1", "googleother", False)] + [(2019, p, k, True) for p in ("Q1", "Q2") for k in "ab"]
    return identity.year_remainders(t("y int, p string, item string, named boolean", rows), ["y"], "p", "item", "named")


@scenario("g string, item string, predecessor string", [("google", "subscriptions", "other")])
def continued_lines(t):
    series = [("google", "other", d(2022, 12, 31), 8796), ("google", "other", d(2023, 9, 30), 8339), ("google", "search", d(2022, 12, 31), 42604), ("google", "search", d(2023, 12, 31), 48020), ("google", "subscriptions", d(2023, 12, 31), 10794)]
    openings = [("google", "subscriptions", d(2023, 12, 31), [10794.0, 8796.0])]
    return identity.continued_lines(t("g string, item string, end date, cells array<double>", openings), t("g string, item string, end date, value double", series), ["g"], "item", "end", "value")


@scenario("y int, item string, true_item string", [(2023, "client", "datacenter"), (2023, "datacenter", "gaming"), (2023, "gaming", "client")])
def relabelled(t):
    schema = "y int, p string, item string, value double"
    q = {"Q1": (1295, 1757, 739), "Q2": (1321, 1581, 998), "Q3": (1598, 1506, 1453)}  # data center, gaming, client as they are
    quarters = [(2023, p, k, v) for p, (dc, g, cl) in q.items() for k, v in (("client", dc), ("datacenter", g), ("gaming", cl))]
    later = [(2023, p, k, v) for p, (dc, g, cl) in q.items() for k, v in (("datacenter", dc), ("gaming", g), ("client", cl))]
    fine = [(2022, p, k, v) for p in ("Q1", "Q2", "Q3") for k, v in (("a", 1), ("b", 2))]
    annual = t("y int, item string, value double", [(2023, "datacenter", 6496), (2023, "gaming", 6212), (2023, "client", 4651)])
    return identity.relabelled(t(schema, quarters + fine), t(schema, later + [(2022, "Q1", "a", 1)]), annual, ["y"], "p", "item", "value")


@scenario("s string, g string, item string, o int", [("mcd", "sales", "iom", 20164), ("mcd", "sales", "lead", 20191)])
def outside_eras(t):
    segments = [("mcd", "iom", y * 10 + q) for y in (2019, 2020) for q in (1, 2)] + [("mcd", "lead", 20161), ("mcd", "lead", 20164), ("mcd", "us", 20161), ("mcd", "us", 20191), ("mcd", "us", 20202)]
    lines = [("mcd", "sales", "iom", "iom", 20164), ("mcd", "sales", "iom", "iom", 20191), ("mcd", "sales", "lead", "lead", 20191), ("mcd", "sales", "us", "us", 20164), ("mcd", "sales", "other", None, 20164), ("mcd", "staff", "iom", "iom", 20164), ("mcd", "sales", "iom", "iom", 20153)]
    return identity.outside_eras(t("s string, g string, item string, segment string, o int", lines), t("s string, segment string, o int", segments), ["s"], "g", "item", "o")


@scenario("g string, id int", [("a", 1)])
def misfiled_years(t):
    rows = [("a", 1, d(2025, 12, 27), 1005), ("a", 2, d(2025, 12, 27), 260), ("b", 3, d(2025, 6, 30), 1000), ("a", 4, d(2025, 12, 31), None)]
    return identity.misfiled_years(t("g string, id int, day date, total double", rows), t("g string, day date, total double", [("a", d(2025, 12, 31), 1000), ("b", d(2025, 12, 31), 1000)]), ["g"], "day", "total")


@scenario("g string, label string", [("a", "Google Services"), ("b", "B")])
def newest_labels(t):
    return identity.newest_labels(t("g string, label string, day date", [("a", "Google", d(2019, 1, 1)), ("a", "Google Services", d(2021, 1, 1)), ("a", "Alpha", d(2021, 1, 1)), ("b", "B", d(2020, 1, 1))]), ["g"], "label", "day")


@scenario("node string, key string", [("a", "a"), ("b", "a"), ("c", "a"), ("e", "e"), ("f", "e"), ("g", "g"), ("x", "x"), ("y", "y")])
def line_keys(t):
    votes = [("a", "b", 3), ("b", "c", 2), ("e", "f", 1), ("f", "g", 5), ("x", "y", 1), ("c", "e", 2)]
    apart, likes = t("a string, b string", [("f", "g"), ("a", "e")]), t("a string, b string", [("e", "f")])
    return identity.line_keys(t("a string, b string, votes long", votes), apart, likes)


# Proofs -----------------------------------------------------------------------------------------------------------------

_LINE = "s string, day date, value double, label string"


@scenario("s string, label string", [("a", "Total net sales")])
def equals_named_line(t):
    flagged = t(_LINE, [("a", d(2025, 9, 27), 1000, "Total net sales"), ("a", d(2025, 9, 27), 500, "Cloud"), ("a", d(2025, 6, 30), 1000, "Total net sales"), ("b", d(2025, 9, 30), 5, "Cost")])
    return proofs.equals_named_line(flagged, t(_LINE, [("a", d(2025, 9, 30), 1000.05, "Net sales"), ("a", d(2025, 9, 30), 500, "Fees"), ("b", d(2025, 9, 30), 6, "Cost")]), ["s"], "day", "value", "label")


@scenario("s string, g string", [("a", "products")])
def adds_to_reported(t):
    parts = [("a", "products", d(2024, 9, 30), v, 5e5) for v in (298e6, 149e6)] + [("a", "regions", d(2024, 9, 30), v, 5e2) for v in (300e6, 149e6)]
    return proofs.adds_to_reported(t("s string, g string, day date, value double, half double", parts), t("s string, day date, value double", [("a", d(2024, 9, 30), 446.5e6)]), ["s"], ["g"], "day", "value", "half")


@scenario("s string, value double, outcome string, restated double", [("same", 100, "confirmed", None), ("other", 100, "restated", 104), ("several", 100, "held", None), ("far", 100, "held", None)])
def later_release(t):
    flagged = t("s string, day date, value double", [(k, d(2024, 9, 28), 100) for k in ("same", "other", "several", "far", "none")])
    after = [("same", d(2025, 9, 27), 100), ("same", d(2025, 9, 27), 7), ("other", d(2025, 9, 27), 104), ("several", d(2025, 9, 27), 104), ("several", d(2025, 9, 27), 103), ("far", d(2025, 9, 27), 400), ("none", d(2025, 12, 31), 100)]
    return proofs.later_release(flagged, t("s string, day date, value double", after), ["s"], "day", "value")


@scenario("s string, g string", [("a", "kpi_fees")])
def unanchored(t):
    breakdowns = t("s string, g string, day date, total double", [("a", "kpi_products", d(2025, 9, 30), 100), ("a", "kpi_fees", d(2025, 9, 30), 60), ("b", "kpi_fees", d(2025, 9, 30), 60)])
    return proofs.unanchored(breakdowns, t("s string, day date, value double", [("a", d(2025, 9, 28), 100.05), ("a", d(2025, 9, 28), 40)]), ["s"], "day", "total", "value")


@scenario("k string, day date", [("fees", d(2024, 3, 31)), ("fees", d(2025, 3, 31))])
def tied_rows(t):
    rows = [("fees", d(2023, 3, 31), 10e6, "f23", [10.0], "accepted"), ("fees", d(2024, 3, 31), 12e6, "f24", [12.0, 10.0], "held"), ("fees", d(2025, 3, 31), 15e6, "f25", [15.0, 12.0], "held"), ("cards", d(2024, 3, 31), 9e6, "f24", [9.0, 8.0], "held"), ("cards", d(2023, 3, 31), 7e6, "f23", [7.0], "accepted"), ("own", d(2023, 3, 31), 5e6, "f24", [5.0], "accepted"), ("own", d(2024, 3, 31), 6e6, "f24", [6.0, 5.0], "held")]
    return proofs.tied_rows(t("k string, day date, value double, filing string, numbers array<double>, status string", rows), ["k"], "day", "value", "filing", "numbers")


@scenario("g string, id int", [("b", 3), ("b", 4)])
def stale_holds(t):
    rows = [("a", 1, "parts differ", True), ("a", 2, "parts differ", False), ("b", 3, "parts differ", False), ("b", 4, "parts differ", False), ("b", 5, None, False)]
    return proofs.stale_holds(t("g string, id int, note string, still boolean", rows), ["g"], "note", c("still"))


@scenario("id int, stated boolean", [(0, True), (1, False), (2, True), (3, True), (4, True), (5, False), (6, False)])
def stated_in_filing(t):
    rows = [("bookings of $792 million", "$792 million", 792e6, "currency", None), ("bookings of 792", "792", 792e6, "currency", None), ("bookings of 792", "792", 792e6, "currency", 1e6), ("A decrease in cross-border volume of 45%", "45%", -45, "percent", None), ("12,400 employees", "12,400", 12400, "count", None), ("12,400 employees", "12,401", 12401, "count", None), ("volume of 45%", "45%", -45, "percent", None)]
    table = t("id int, q string, v string, x double, u string, f double", [(i, *r) for i, r in enumerate(rows)])
    return table.select("id", proofs.stated_in_filing(c("q"), c("v"), c("x"), c("u"), c("f")).alias("stated"))


@scenario("q string, item string, value double", [("2020Q2", "rpo", 108)])
def filled_by_tag(t):
    readings = t("q string, item string", [("2020Q1", "rpo"), ("2020Q3", "rpo"), ("2020Q1", "two")])
    facts = t("q string, tag string, value double", [("2020Q1", "Obligation", 100), ("2020Q2", "Obligation", 108), ("2020Q2", "A", 5), ("2020Q2", "B", 6)])
    return proofs.filled_by_tag(readings, facts, t("item string, tag string", [("rpo", "Obligation"), ("two", "A"), ("two", "B")]), ["q"], "item", "tag", "value")


@scenario("q string, value double, exact double", [("a", 4.65e9, 4.651e9)])
def exact_values(t):
    facts = [("a", 4.651e9), ("a", 9e9), ("b", 3.0), ("c", 20.1e9), ("c", 19.9e9)]
    return proofs.exact_values(t("q string, value double", [("a", 4.65e9), ("b", 3.65), ("c", 20e9)]), t("q string, value double", facts), ["q"], "value")


@scenario("k string, before double, after double", [("b", 100, 90)])
def reread_disagreements(t):
    schema = "k string, value double"
    return proofs.reread_disagreements(t(schema, [("a", 100), ("b", 100), ("c", 5)]), t(schema, [("a", 100.2), ("b", 90)]), ["k"], "value")


@scenario("item string, tag string", [("rpo", "Obligation")])
def learned_tags(t):
    readings = [("q1", "rpo", 4.65e9), ("q2", "rpo", 4.8e9), ("q1", "margin", 7), ("q2", "margin", 7), ("q1", "fees", 5.5), ("q2", "fees", 6.5)]
    facts = [("q1", "Obligation", 4.651e9), ("q2", "Obligation", 4.799e9), ("q1", "Other", 4.65e9), ("q2", "Other", 9e9), ("q1", "Rate", 7.0), ("q2", "Rate", 7.0), ("q1", "Fees", 5.5)]
    return proofs.learned_tags(t("q string, item string, value double", readings), t("q string, tag string, value double", facts), ["q"], "item", "tag", "value")


@scenario("g string, item string, value double", [("a", "x", 40), ("a", "y", 10)])
def settled(t):
    agreed = t("g string, item string, value double", [("a", "z", 50), ("b", "z", 50)])
    disputed = [("a", "x", "A", 40), ("a", "y", "A", 10), ("a", "x", "B", 41), ("a", "y", "B", 10), ("b", "x", "A", 50), ("b", "x", "B", 50)]
    return proofs.settled(agreed, t("g string, item string, reader string, value double", disputed), t("g string, total double", [("a", 100), ("b", 100)]), ["g"], "item", "value", "total")


@scenario("rule string, state string", [("good", "live"), ("fell", "demoted"), ("new", "shadow"), ("again", "live")])
def rule_states(t):
    day = lambda k: d(2025, 1, k)
    rows = [("good", day(k), True) for k in (1, 2, 3)] + [("fell", day(k), k < 4) for k in (1, 2, 3, 4)] + [("new", day(1), True)] + [("again", day(k), k != 2) for k in (1, 2, 3, 4, 5)]
    return proofs.newest_evidence(t("rule string, day date, agreed boolean", rows), "rule", "day")


@scenario("k string, kind string", [("a", "equals_xbrl"), ("b", "confirmed_later")])
def choose_evidence(t):
    rows = [("a", "confirmed_later"), ("a", "equals_xbrl"), ("b", "confirmed_later"), ("b", "rumour"), ("c", "rumour")]
    return proofs.choose_evidence(t("k string, kind string", rows), ["k"], ["equals_xbrl", "adds_to_xbrl", "confirmed_later"])


# Checks -----------------------------------------------------------------------------------------------------------------

_LOANS = [("g", i, k, k) for i, k in enumerate(["ci", "cre", "construction", "leases", "Total commercial", "home", "cards", "Total consumer", "Total loans"])]


@scenario("g string, total string, parts string", [("g", "Total commercial", "ci,cre,construction,leases"), ("g", "Total consumer", "home,cards"), ("g", "Total loans", "Total commercial,Total consumer")])
def ordered_runs(t):
    out = checks.ordered_runs(t("g string, o int, k string, label string", _LOANS), ["g"], "o", "k", "label")
    return out.withColumn("parts", F.array_join("parts", ","))


@scenario("g string, total string, p int, holds boolean", [("g", "total", p, p != 5) for p in range(6)])
def learned_totals(t):
    runs = t("g string, total string, parts array<string>", [("g", "total", ["a", "b"]), ("g", "never", ["a", "b"])])
    figures = [("g", p, k, v * 1e6) for p in range(6) for k, v in (("a", 60 + p), ("b", 40), ("total", 100 + p if p != 5 else 90), ("never", 7))] + [("g", 9, "a", 1.0)]
    return checks.learned_totals(runs, t("g string, p int, k string, value double", figures), ["g"], "p", "k", "value")


@scenario("id int, one boolean", [(0, True), (1, False), (2, True), (3, False), (4, False), (5, False)])
def states_one_period(t):
    rows = [([135.0], ""), ([135.0, 108.0], ""), (None, "fee-generating credit AUM of $135 billion in 2026"), (None, "$135 billion, up from $108 billion a year ago"), (None, "in 2024 $135 billion"), (None, "")]
    table = t("id int, n array<double>, q string", [(i, *r) for i, r in enumerate(rows)])
    return table.select("id", checks.states_one_period(c("n"), c("q"), F.array(F.lit(2026))).alias("one"))


@scenario("id int, shows boolean", [(0, True), (1, False), (2, False)])
def row_shows(t):
    table = t("id int, n array<double>, v double, o double", [(0, [737.0, 737.0], 737e6, 737e6), (1, [737.0, 700.0], 737e6, 737e6), (2, [737.0], 737e6, 737e6)])
    return table.select("id", checks.row_shows(c("n"), c("v"), c("o")).alias("shows"))


@scenario("g string, k string", [("a", "y")])
def unread_lines(t):
    return checks.unread_lines(t("g string, k string", [("a", "x"), ("a", "y")]), t("g string, k string, v double", [("a", "x", 1), ("b", "y", 2)]), ["g", "k"])


@scenario("check string, findings long", [("negative", 2), ("large", 1)])
def stored_audit(t):
    rows = t("id int, group_kind string, method string, value double", [(1, "metric", "ai", -1), (2, "mix", "xbrl", -5), (3, "metric", "ai", 900)])
    return checks.audited(rows, ["id"], [checks.Check("negative", c("value") < 0, kinds=("mix",)), checks.Check("large", c("value") > 500, methods=("xbrl",))])


@scenario("s string, total string, result string", [("ok", "Total current assets", "pass"), ("ok", "Total assets", "pass"), ("bad", "Total assets", "fail"), ("one", "Total assets", "none")])
def printed_totals(t):
    rows = [("ok", 1, "Cash", 10), ("ok", 2, "Receivables", 20), ("ok", 3, "Total current assets", 30), ("ok", 4, "Plant", 5), ("ok", 5, "Goodwill", 6), ("ok", 6, "Total assets", 41), ("bad", 1, "Cash", 10), ("bad", 2, "Plant", 20), ("bad", 3, "Total assets", 50), ("one", 1, "Cash", 10), ("one", 2, "Total assets", 10)]
    return checks.printed_totals(t("s string, o int, label string, value double", rows), ["s"], "o", "label", "value")


@scenario("s string, section string, result string", [("a", "operating", "pass"), ("a", "investing", "fail"), ("a", "financing", "none")])
def section_totals(t):
    rows = [("Cash flows from operating activities", None), ("Net income", 100), ("Depreciation", 20), ("Net cash provided by operating activities", 120), ("Investing activities:", None), ("Capital expenditures", -50), ("Sales of securities", 10), ("Net cash used in investing activities", -30), ("Dividends", -5), ("Net cash used in financing activities", -5)]
    return checks.section_totals(t("s string, o int, label string, value double", [("a", i, *r) for i, r in enumerate(rows)]), ["s"], "o", "label", "value")


@scenario("r string, check string, result string", [("a", "balance", "pass"), ("a", "profit", "pass"), ("a", "cash", "pass"), ("b", "balance", "fail"), ("b", "profit", "none"), ("b", "cash", "pass"), ("c", "balance", "none"), ("c", "profit", "fail"), ("c", "cash", "none")])
def tagged_identities(t):
    cash = "CashAndCashEquivalentsAt{}OfPeriod"
    rows = {
        "a": {"Assets": 100, "EquityAndLiabilities": 100, "CurrentAssets": 40, "NoncurrentAssets": 60, "ProfitLoss": 10, "ProfitLossAttributableToOwnersOfParent": 9, "ProfitLossAttributableToNoncontrollingInterests": 1, "IncreaseDecreaseInCashAndCashEquivalents": 5, cash.format("Beginning"): 10, cash.format("End"): 15},
        "b": {"Assets": 100, "Liabilities": 60, "Equity": 30, "IncreaseDecreaseInCashAndCashEquivalents": 5, "CashFlowsFromUsedInOperatingActivities": 20, "CashFlowsFromUsedInInvestingActivities": -12, "CashFlowsFromUsedInFinancingActivities": -4, "EffectOfExchangeRateChangesOnCashAndCashEquivalents": 1},
        "c": {"Assets": 100, "ProfitLoss": 10, "ProfitLossAttributableToOwnersOfParent": 5, "ProfitLossAttributableToNoncontrollingInterests": 1},
    }
    return checks.tagged_identities(t("r string, tag string, value double, unit double", [(r, k, v, 1) for r, x in rows.items() for k, v in x.items()]), ["r"], "tag", "value", "unit")


@scenario("s string, id int, proved boolean", [("a", 1, True), ("a", 2, False)])
def cash_by_balances(t):
    flows = t("s string, id int, accession string, start date, end date, change double", [("a", 1, "f1", d(2024, 1, 1), d(2024, 12, 31), 500000), ("a", 2, "f2", d(2024, 1, 1), d(2024, 12, 28), 800000), ("a", 3, "f1", d(2020, 1, 1), d(2020, 12, 31), 5)])
    balances = t("s string, accession string, day date, cash double, filed date", [("a", "f1", d(2023, 12, 31), 1000000, d(2025, 2, 1)), ("a", "f0", d(2023, 12, 31), 999000, d(2026, 2, 1)), ("a", "f1", d(2024, 12, 31), 1500000, d(2025, 2, 1))])
    return checks.cash_by_balances(flows, balances, ["s"])


@scenario("r string, matched long, missing long, differing long, result string", [("a", 2, 1, 0, "pass"), ("b", 1, 0, 1, "fail"), ("c", 0, 1, 0, "none")])
def second_opinion(t):
    schema = "r string, concept string, value double"
    lines = t(schema, [("a", "x", 5), ("a", "y", -6), ("a", "z", 7), ("a", "h", None), ("b", "x", 5), ("b", "y", 6), ("c", "x", 1)])
    return checks.second_opinion(lines, t(schema, [("a", "x", 5), ("a", "x", 9), ("a", "y", 6), ("b", "x", 5), ("b", "y", 7)]), ["r"], "concept", "value")


@scenario("s string, parent string, result string", [("a", "total", "declared"), ("b", "total", "completed"), ("c", "total", "fail")])
def completed_sums(t):
    lines = [("a", "x", 1, "p", 10), ("a", "y", 2, "p", 20), ("a", "total", 3, "p", 30), ("b", "x", 1, "p", 10), ("b", "y", 2, "p", 20), ("b", "z", 3, "p", 5), ("b", "total", 4, "p", 35), ("b", "after", 5, "p", 99), ("b", "elsewhere", 0, "q", 99), ("c", "x", 1, "p", 10), ("c", "y", 2, "p", 20), ("c", "total", 3, "p", 40)]
    return checks.completed_sums(t("s string, concept string, position int, place string, value double", lines), t("parent string, child string", [("total", "x"), ("total", "y")]), ["s"])


# Choices ----------------------------------------------------------------------------------------------------------------


@scenario("id int, source_rank int", [(0, 0), (1, 1), (2, 0), (3, 2), (4, 3), (5, 0)])
def source_rank(t):
    rows = [("10-K", "sec", True), ("10-Q", "sec", True), ("10-Q", "sec", False), ("6-K", "regulator", True), ("6-K", "sec", False), ("20-F/A", "sec", True)]
    return t("id int, form string, source string, annual boolean", [(i, *r) for i, r in enumerate(rows)]).select("id", selection.source_rank(c("form"), c("source"), c("annual")).alias("source_rank"))


@scenario("y int, basis string, id string", [(2012, "ROC GAAP", "f2012"), (2012, "TIFRS", "t2013")])
def other_bases(t):
    kept = [(2012, "IFRS", "group", "f2013", d(2014, 4, 1)), (2012, "ROC GAAP", "group", "f2012", d(2013, 4, 1)), (2012, "ROC GAAP", "parent", "p2012", d(2013, 5, 1)), (2012, "TIFRS", "group", "t2012", d(2013, 3, 1)), (2012, "TIFRS", "group", "t2013", d(2013, 8, 1)), (2012, None, "group", "none", d(2013, 8, 1))]
    winners = t("y int, basis string, scope string", [(2012, "IFRS", "group")])
    return selection.other_bases(t("y int, basis string, scope string, id string, filed date", kept), winners, ["y"], "basis", "scope", [F.desc("filed"), F.col("id")])


@scenario("id int, power int", [(0, 3), (1, 6), (2, 0), (3, 0), (4, 0), (5, 0)])
def per_share_scale(t):
    rows = [(1241.6, 1.24, 2), (1240000.0, 1.24, 2), (1.24, 1.24, 2), (-1240.0, 1.24, 2), (0.88, 0.006, 2), (0.0, 1.0, 2)]
    return t("id int, a double, b double, n int", [(i, *r) for i, r in enumerate(rows)]).select("id", selection.per_share_scale(c("a"), c("b"), c("n")).alias("power"))


@scenario("s string, name string, value double", [("i", "net income", 57411), ("i", "revenue", 274515), ("b", "total assets", 323888), ("f", "closing cash", 39789)])
def key_figures(t):
    rows = [("i", "income", 1, "printed_x", "Total net sales", 274515), ("i", "income", 2, "printed_y", "Sales of services", 53768), ("i", "income", 3, "us-gaap_NetIncomeLoss", "Net income", 57411), ("i", "income", 4, "us-gaap_NetIncomeLoss", "Net income", 3.31), ("i", "income", 5, "printed_z", "Net income attributable", 99999), ("b", "balance", 1, "us-gaap_Assets", "Total assets", 323888), ("b", "balance", 2, "printed", "Total assets held", 5), ("f", "cash_flow", 1, "printed_a", "Cash, beginning of year", 50224), ("f", "cash_flow", 2, "printed_b", "Cash, end of year", 39789)]
    return selection.key_figures(t("s string, statement string, position int, concept string, label string, value double", rows), ["s"])


@scenario("tbl string, verdict string", [("own", "verified"), ("else", "verified elsewhere"), ("none", "unverified"), ("bad", "contradicted"), ("defined", "verified")])
def summary_verdicts(t):
    schema = "accession string, year int, name string, value double"
    rows = [("own", "f1", 2000, "revenue", 100), ("own", "f1", 2000, "net income", 10), ("else", "f9", 2000, "total assets", 500), ("none", "f1", 1990, "revenue", 1), ("bad", "f1", 2000, "net income", 99), ("defined", "f1", 2000, "revenue", 70), ("defined", "f1", 2000, "net income", 10)]
    return selection.summary_verdicts(t("tbl string, " + schema, rows), t(schema, [("f1", 2000, "revenue", 100), ("f1", 2000, "net income", 10), ("f1", 2000, "total assets", 500)]), "tbl")


@scenario("y int, name string, value double", [(1990, "revenue", 6)])
def years_without(t):
    figures = t("y int, name string, value double, filed date", [(1990, "revenue", 5, d(1995, 1, 1)), (1990, "revenue", 6, d(1996, 1, 1)), (2000, "revenue", 9, d(2001, 1, 1))])
    return selection.years_without(figures, t("y int, name string", [(2000, "revenue")]), ["y", "name"], [F.desc("filed"), F.col("value")])


QUERIES = {k: scenarios.QUERIES[k] for k in scenarios.QUERIES if k not in _before}
SQL = {k: scenarios.SQL[k] for k in QUERIES}
