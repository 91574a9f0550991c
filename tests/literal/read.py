"""Readers over small literal tables and texts, beside the rows that have to come out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import readers, selectors
from . import scenarios
from .scenarios import scenario

_before = set(scenarios.QUERIES)
d, c = dt.date, F.col


@scenario("line int, label string, figures string", [(0, "Net sales", "$1,234|(5.6)"), (2, "Cost of sales", "900|—")])
def dot_leader_rows(t):
    text = "Net sales ........ $1,234  (5.6)\nA heading\nCost of sales..... 900 —\n......... 5"
    return readers.dot_leader_rows(t("f string, text string", [("f", text)]), ["f"], "text").withColumn("figures", F.array_join("figures", "|"))


@scenario("row int, label string, figures string", [(0, "Net system sales", "5,596.1|6,564.8"), (1, "Gross margin", "53.7%|54.0%"), (2, "Total cost of sales", "(3,562.2)|(4,291.1)")])
def text_run_rows(t):
    text = "(Unaudited, in millions) 2025 2026 Net system sales 5,596.1 6,564.8 Gross margin 53.7 % 54.0 % Total cost of sales (3,562.2) (4,291.1)"
    return readers.text_run_rows(t("f string, text string", [("f", text), ("g", "no years here 5 6")]), ["f"], "text").withColumn("figures", F.array_join("figures", "|"))


@scenario("line int, level int, label string, figures string", [(0, 0, "Assets", ""), (1, 2, "Cash and equivalents", "1,234|(5)"), (3, 0, "Total assets", "2,000|-")])
def text_lines(t):
    text = "Assets\n  Cash and equivalents    $  1,234    (5)\n\nTotal assets  2,000   -"
    return readers.text_lines(t("f string, text string", [("f", text)]), ["f"], "text").withColumn("figures", F.array_join("figures", "|"))


@scenario("id int, positioned boolean, slides boolean", [(0, True, False), (1, False, False), (2, False, True)])
def page_kinds(t):
    pages = [(0, '<div style="position:absolute">x</div>' * 301), (1, '<div style="position:absolute">x</div>' * 301 + "<tr>"), (2, '<p style="font-size:1px">Net sales</p><p style="font-size: 1px">5</p>')]
    return t("id int, html string", pages).select("id", readers.is_positioned(c("html")).alias("positioned"), readers.is_slides(c("html")).alias("slides"))


@scenario("id int, caption boolean", [(0, True), (1, True), (2, False), (3, False)])
def caption_rows(t):
    labels = ["(In millions, except share amounts)", "in thousands of U.S. dollars", "Shares used in computing earnings per share (in thousands):", "Net sales"]
    return t("id int, label string", list(enumerate(labels))).select("id", readers.caption_only(c("label")).alias("caption"))


@scenario("id int, segmented boolean", [(0, True), (1, False)])
def region_columns(t):
    return t("id int, cells array<string>", [(0, ["", "Brazil", "United States"]), (1, ["", "Brazil", "2025"])]).select("id", readers.by_region(c("cells"), ["brazil", "united states", "argentina"]).alias("segmented"))


_CELLS = "f string, tbl string, row int, col int, text string"


def _cells(tbl, rows):
    return [("f", tbl, r, k, x) for r, line in enumerate(rows) for k, x in enumerate(line)]


@scenario("item string, value double, problem string", [("sales", 5e6, None), ("gone", None, "no_cell"), ("words", None, "no_figure"), ("moved", None, "other_row")])
def located_values(t):
    cells = t(_CELLS, _cells("T1", [["", "2025"], ["Net sales", "$5"], ["Cost", "n/a"]]))
    locators = [("f", "sales", "T1", 1, 1, 1e6, "Net sales"), ("f", "gone", "T1", 9, 1, 1.0, None), ("f", "words", "T1", 2, 1, 1.0, "Cost"), ("f", "moved", "T1", 1, 1, 1.0, "Gross profit")]
    return readers.located(t("f string, item string, tbl string, row int, col int, scale double, label string", locators), cells, ["f"])


@scenario("item string, tbl string, row int, text string, problem string", [("sales", "T1", 1, "$5", None), ("gains", "T1", 2, "—", None), ("cash", None, None, None, "found more than once"), ("none", None, None, None, "not found")])
def replayed_rows(t):
    cells = t(_CELLS, _cells("T1", [["", "2025"], ["Net sales (1)", "$5"], ["Net losses from equity securities", "—"], ["Cash", "7"]]) + _cells("T2", [["Cash", "8"]]))
    last = [("f", "sales", "Net sales", 1), ("f", "gains", "Net gains from equity securities", 1), ("f", "cash", "Cash", 1), ("f", "none", "Goodwill", 1)]
    return readers.replayed(t("f string, item string, label string, col int", last), cells, ["f"])


@scenario("grp string, tbl string, first_row int, last_row int, total_row int", [("nodes", "T2", 1, 3, 4)])
def replayed_tables(t):
    cells = t(_CELLS, _cells("T1", [["", "2025"], ["3-nanometer", "5"], ["Total", "5"]]) + _cells("T2", [["", "2025"], ["3-nanometer", "5"], ["5-nanometer", "6"], ["2-nanometer", "1"], ["Wafer revenue", "12"]]))
    parts = [("f", "nodes", "3-nanometer", "Wafer revenue"), ("f", "nodes", "5-nanometer", "Wafer revenue"), ("f", "geo", "US", "Total"), ("f", "geo", "China", "Total")]
    return readers.replayed_table(t("f string, grp string, label string, total_label string", parts), cells, ["f"])


@scenario("item string, sentence string", [("dap", "DAP was 3.71 billion on average for September 2026.")])
def replayed_quotes(t):
    last = t("f string, item string, quote string", [("f", "dap", "DAP was 3.60 billion on average for June 2026."), ("f", "two", "We have 5 stores.")])
    sentences = [("f", "DAP was 3.71 billion on average for September 2026."), ("f", "We have 6 stores."), ("f", "We have 7 stores."), ("f", "Other.")]
    return readers.replayed_quotes(last, t("f string, sentence string", sentences), ["f"])


@scenario("id int, figure string", [(0, "$1.3 billion"), (1, None), (2, None)])
def anchored_figures(t):
    texts = [(0, "In Q3 adjusted net income was $1.3 billion, up 5%."), (1, "net income was $1.3 billion; last year net income was $1.1 billion"), (2, "nothing")]
    return t("id int, text string", texts).select("id", readers.anchored(c("text"), F.array(F.lit("net"), F.lit("income"), F.lit("was"))).alias("figure"))


@scenario("item string, value_text string", [("outflows", "886")])
def quoted_rows(t):
    last = t("f string, item string, label string, figures int, place int", [("f", "outflows", "Outflows", 4, 3), ("f", "twice", "Inflows", 2, 0)])
    lines = [("f", "Outflows3", ["1,658", "(263)", "(509)", "886"]), ("f", "Outflows3", ["1", "2"]), ("f", "Inflows", ["1", "2"]), ("f", "Inflows", ["3", "4"])]
    return readers.quoted_rows(last, t("f string, label string, figures array<string>", lines), ["f"])


@scenario("o int, twin int", [(3, 1)])
def earlier_twins(t):
    a = [["", "Revenues", "Volume"], ["Europe", "5", "6"], ["Asia", "7", "8"]]
    b = [["", "Revenues", "Volume"], ["Europe", "15", "16"], ["Asia", "17", "18"]]
    return readers.earlier_twins(t("f string, o int, rows array<array<string>>", [("f", 1, a), ("f", 2, a[:2]), ("f", 3, b), ("g", 4, b)]), ["f"], "o")


@scenario("tbl string, member string, value double", [("T2", "launch", 70), ("T2", "connect", 30)])
def release_breakdown(t):
    members = t("f string, member string, year_ago double", [("f", "launch", 60), ("f", "connect", 20)])
    rows = [("f", "T1", "launch", 70, 61, 0.5), ("f", "T1", "connect", 30, 20, 0.5), ("f", "T1", None, 100, 80, 0.5), ("f", "T2", "launch", 70, 60.2, 0.5), ("f", "T2", "connect", 30, 20, 0.5), ("f", "T2", None, 100, 80, 0.5), ("f", "T3", "launch", 70, 60, 0.5), ("f", "T3", None, 70, 60, 0.5)]
    return readers.release_lines(members, t("f string, tbl string, member string, value double, prior double, tol double", rows), ["f"])


@scenario("row string, finish date, value double", [("a", d(2025, 6, 30), 40), ("a", d(2026, 3, 31), 55), ("b", d(2025, 6, 30), 4)])
def earlier_quarters(t):
    own = d(2026, 6, 30)
    rows = [("a", own, 3, 60, True), ("a", d(2025, 6, 30), 3, 40, True), ("a", own, 6, 115, True), ("b", own, 3, 6, False), ("b", d(2025, 6, 30), 3, 4, False), ("b", own, 6, 11, False)]
    return readers.earlier_quarters(t("row string, end date, months int, value double, additive boolean", rows), ["row"], F.lit(own), c("additive")).withColumnRenamed("end", "finish")


@scenario("id int, y int, q int, value double", [(0, 2022, 4, 5431), (0, 2023, 1, 5778), (1, 2022, 4, 91), (1, 2023, 1, 86)])
def quarter_rows(t):
    a = readers.quarter_rows(t("id int, text string", [(0, "Q4 2022 Q1 2023 Net sales 5,431 5,778 Gross 1 2")]), ["id"], "text", "Net sales")
    b = readers.quarter_rows(t("id int, text string", [(1, "Q4 2022 Q1 2023 Lithography systems sold (units) 1 91 86")]), ["id"], "text", "Lithography systems sold (units)", offset=1)
    return a.union(b)


@scenario("id int, name string, fits boolean", [(0, "Revenue remaining [RevenueRemainingPerformanceObligation] | Commercial Customers", True), (1, "Number Of Segments [NumberOfSegments]", False), (2, "Dividend [DividendPerShare]", False)])
def fact_lines(t):
    rows = [(0, "us-gaap:RevenueRemainingPerformanceObligation", "Revenue remaining", ["msft:CommercialCustomersMember"], "currency", "iso4217:USD", "Backlog"), (1, "us-gaap:NumberOfSegments", None, [], "percent", "pure", "Share"), (2, "us-gaap:DividendPerShare", "Dividend", [], "currency", "iso4217:USD/shares", "Revenue per pound")]
    table = t("id int, concept string, label string, members array<string>, unit string, fact_unit string, item string", rows)
    return table.select("id", readers.fact_names(c("concept"), c("label"), c("members")).alias("name"), readers.unit_fits(c("unit"), c("fact_unit"), c("item"), c("concept")).alias("fits"))


@scenario("scope string, code string, place int, value double", [("con", "3.01", 1, 5000), ("con", "3.02", 2, -2000), ("con", "3.10", 3, 3000), ("con", "3.99.01", 4, 0.5)])
def coded_forms(t):
    rows = [("f", "DRE", "con", "MIL", "3.10", "Lucro", 3), ("f", "DRE", "con", "MIL", "3.02", "Custo", -2), ("f", "DRE", "con", "MIL", "3.01", "Receita", 5), ("f", "DRE", "con", "MIL", "3.99.01", "Lucro por ação", 0.5), ("f", "DRE", "ind", "MIL", "3.01", "Receita", 0), ("f", "XYZ", "con", "MIL", "9", "x", 1)]
    return readers.coded_forms(t("f string, part string, scope string, scale string, code string, label string, value double", rows), ["f"]).withColumnRenamed("position", "place")


@scenario("k string, concept string, start date, finish date, value double", [
    ("q", "Revenue", d(2024, 4, 1), d(2024, 6, 30), 5), ("q", "Revenue", d(2024, 1, 1), d(2024, 6, 30), 9), ("q", "Assets", None, d(2024, 6, 30), 50), ("q", "Assets", None, d(2023, 12, 31), 45), ("q", "Cash", d(2024, 1, 1), d(2024, 6, 30), 3), ("q", "Cash", d(2023, 1, 1), d(2023, 6, 30), 2),
    ("y", "Revenue", d(2024, 1, 1), d(2024, 12, 31), 20), ("y", "Revenue", d(2023, 1, 1), d(2023, 12, 31), 18),
])
def report_columns(t):
    rows = [("q", 6, False, "income", "Revenue", 5, None, 9), ("q", 6, False, "balance", "Assets", 50, 45, None), ("q", 6, False, "cash_flow", "Cash", 3, 2, None), ("y", 12, True, "income", "Revenue", 20, 18, None)]
    table = t("k string, m int, annual boolean, statement string, concept string, thstrm_amount double, frmtrm_amount double, thstrm_add_amount double", rows)
    parts = [readers.report_columns(table.where(c("k") == k), ["k"], F.lit(2024), F.lit(m), F.lit(a)) for k, m, a in (("q", 6, False), ("y", 12, True))]
    return parts[0].union(parts[1]).withColumnRenamed("end", "finish")


@scenario("id int, finish date, period_type string, multiplier double, assets double, income double", [(0, d(1996, 12, 31), "YEAR", 1000, 5000, -120000), (1, None, None, None, None, None)])
def schedule_tags(t):
    text = "<PERIOD-TYPE> YEAR\n<PERIOD-END> DEC-31-1996\n<MULTIPLIER> 1,000\n<TOTAL-ASSETS> 5\n<NET-INCOME> (120)\n"
    x = readers.schedule(c("text"))
    return t("id int, text string", [(0, text), (1, "<TOTAL-ASSETS> 5")]).select("id", x["end"].alias("finish"), *[x[n].alias(n) for n in ("period_type", "multiplier", "assets", "income")])


@scenario("t string, k int", [("a", 2)])
def translated_columns(t):
    rows = [("a", 1, "2003", "TWD"), ("a", 2, "2003", "USD"), ("a", 3, "2002", "TWD"), ("b", 1, "2003", "USD")]
    return readers.translated_columns(t("t string, col int, period string, currency string", rows), ["t"], F.lit("TWD")).withColumnRenamed("col", "k")


@scenario("k int, side int", [(1, 1), (2, 1), (3, 2), (4, 2)])
def side_by_side(t):
    rows = [("a", 1, "2025"), ("a", 2, "2024"), ("a", 3, "2025"), ("a", 4, "2024")]
    return readers.scopes_side_by_side(t("t string, col int, period string", rows), ["t"]).withColumnRenamed("col", "k")


@scenario("g string, item string, value double", [("all", "a", 60), ("all", "b", 50), ("all", "corporate", -8), ("all", "rounding", -2), ("one", "a", 60), ("one", "b", 50), ("one", "corporate", -10), ("rest", "a", 60), ("rest", "b", 50), ("rest", "left over", -10), ("fits", "a", 60), ("fits", "b", 40)])
def segment_income(t):
    schema = "g string, item string, value double"
    members = t(schema, [(g, k, v) for g in ("all", "one", "rest") for k, v in (("a", 60), ("b", 50))] + [("fits", "a", 60), ("fits", "b", 40), ("lone", "a", 9)])
    other = t(schema, [("all", "corporate", -8), ("all", "rounding", -2), ("one", "corporate", -10), ("one", "stray", 5), ("rest", "stray", 3), ("fits", "stray", 3)])
    return readers.segment_parts(members, other, t("g string, total double", [(g, 100) for g in ("all", "one", "rest", "fits", "lone")]), ["g"])


@scenario("share string, label string", [("45%", "Advertising"), ("30%", "Cloud")])
def chart_labels(t):
    rows = [("p", "Advertising", 100, 90), ("p", "45%", 102, 101), ("p", "Cloud", 200, 90), ("p", "30%", 198, 100), ("p", "25%", 400, 400), ("p", "Hardware", 300, 90)]
    return readers.chart_labels(t("p string, text string, x double, y double", rows), ["p"])


@scenario("k string, was double, now double, change string", [("b", 100, 100.2, "rounded"), ("c", 100, 90, "changed"), ("d", 100, None, "lost")])
def rule_changes(t):
    schema = "k string, v double"
    return readers.rule_changes(t(schema, [(k, 100) for k in "abcd"]), t(schema, [("a", 100), ("b", 100.2), ("c", 90)]), ["k"], "v")


@scenario("id int, basis string", [(0, "US GAAP"), (1, "IFRS"), (2, None)])
def stated_basis(t):
    texts = ["The notes are prepared under IFRS. In our opinion, the statements present fairly the position in conformity with U.S. GAAP.", "The statements are prepared in accordance with International Financial Reporting Standards.", "Nothing is said."]
    return t("id int, text string", list(enumerate(texts))).select("id", readers.stated_basis(c("text")).alias("basis"))


@scenario("id int, words string", [(0, "mexican economic development"), (1, "taiwan semiconductor manufacturing")])
def registrant_names(t):
    covers = ["FORM 6-K\nMexican Economic Development, Inc.\n(Exact name of registrant as specified in its charter)", "Taiwan Semiconductor Manufacturing Company Ltd.\n(Name of Registrant)"]
    return t("id int, cover string", list(enumerate(covers))).select("id", F.array_join(readers.registrant_words(c("cover")), " ").alias("words"))


@scenario("id int, explains boolean", [(0, True), (1, False), (2, False), (3, True)])
def explanations(t):
    quotes = [(0, "Pension inflows of 12.0 were driven by a large transaction"), (1, "We expect revenue from AI to be 12 because of demand"), (2, "Inflows were 12.0 in the quarter under review"), (3, "Pension volumes grew following the acquisition of Athene")]
    return t("id int, q string", quotes).select("id", readers.explains(c("q"), F.lit("Pension inflows"), F.array(F.lit("12"), F.lit("12.0"))).alias("explains"))


@scenario("id int, record string, numbers string", [(0, '{"table":"T1","row":2}', "5.0,7.0"), (1, '{"table":"T1"}', "-3.0")])
def provenance(t):
    table = t("id int, tbl string, r int, cells array<string>", [(0, "T1", 2, ["Sales", "7", "$5", "n/a words"]), (1, "T1", None, ["Cost", "", "(3)"])])
    return table.select("id", readers.locator_record({"table": c("tbl"), "row": c("r")}).alias("record"), F.array_join(readers.row_numbers(c("cells"), F.lit(2)).cast("array<string>"), ",").alias("numbers"))


@scenario("record string, same boolean", [('{"a":1,"b":"x"}', True)])
def unit_records(t):
    x = readers.unit_record(["b", "a"])
    return t("b string, a int", [("x", 1)]).select(x["record"].alias("record"), (x["digest"] == F.sha2(F.lit('{"a":1,"b":"x"}'), 256)).alias("same"))


@scenario("accession string", [("new",), ("old_rules",)])
def not_empty(t):
    memory = t("k string, accession string, patterns string", [("k", "empty", "v2"), ("k", "old_rules", "v1")])
    return readers.not_empty(t("k string, accession string", [("k", a) for a in ("new", "empty", "old_rules")]), memory, ["k"], "accession", "v2")


@scenario("y int", [(2020,)])
def common_bases(t):
    schema = "y int, basis string"
    return readers.common_bases(t(schema, [(2020, "IFRS"), (2020, "GAAP"), (2021, "IFRS")]), t(schema, [(2020, "IFRS"), (2021, "GAAP")]), ["y"], "basis")


@scenario("g string, item string", [("a", "x"), ("a", "extra")])
def asked_of(t):
    last = t("s string, g string, item string, whole boolean", [("s", "a", "x", False), ("s", "a", "extra", True), ("s", "a", "dropped", False), ("s", "z", "row", True)])
    return readers.asked_of(last, t("s string, g string, item string", [("s", "a", "x"), ("s", "a", "y")]), ["s"], "g", "item", "whole")


@scenario("k string, starts long", [("a", 2)])
def distinct_evidence(t):
    return readers.distinct_evidence(t("k string, start date", [("a", d(2020, 1, 1)), ("a", d(2020, 4, 1)), ("a", d(2020, 4, 1)), ("b", d(2020, 1, 1))]), ["k"], "start")


@scenario("s string, snapshot string", [("a", '[{"period_end":"2025-12-31","statement":"income","lines":[1.0]},{"period_end":"2024-12-31","statement":"income","lines":[2.0]}]')])
def served_snapshot(t):
    rows = [("a", d(2024, 12, 31), "income", [2.0]), ("a", d(2025, 12, 31), "income", [1.0])]
    return readers.served_snapshot(t("s string, period_end date, statement string, lines array<double>", rows), ["s"], "lines")


@scenario("id int, why string", [(0, None), (1, "period"), (2, "annual")])
def why_not_alone(t):
    rows = t("id int, off int, annual boolean", [(0, 2, False), (1, 40, True), (2, 0, True)])
    return rows.select("id", readers.why_not_alone(rows, {"period": c("off") > 12, "annual": c("annual")}).alias("why"))


@scenario("tbl string, row int, printed string", [("T1", 1, "Net sales | $5")])
def hand_check(t):
    cells = t(_CELLS, _cells("T1", [["", "2025"], ["Net sales", "$5"], ["Cost", "3"]]))
    return readers.hand_check(t("f string, tbl string, row int", [("f", "T1", 1)]), cells, ["f"])


@scenario("s string, filings long, kept long, failed long, seconds double", [("a", 3, 2, 1, 6), ("b", 1, 1, 0, 4)])
def run_report(t):
    rows = [("a", "kept", 1), ("a", "kept", 2), ("a", "failed", 3), ("b", "kept", 4)]
    return readers.run_report(t("s string, status string, seconds double", rows), ["s"], ["kept", "failed"])


# Selectors --------------------------------------------------------------------------------------------------------------

_VALUES = "group_key string, kpi_key string, fiscal_year int, fiscal_period string, value double"


@scenario("kpi_key string, value double, value_right double", [("a", 1, 5)])
def same_identity(t):
    left = t(_VALUES, [("g", "a", 2024, "Q1", 1), ("g", "b", 2024, "Q1", 2)])
    return selectors.same_identity(left, t(_VALUES, [("g", "a", 2024, "Q1", 5), ("g", "b", 2024, "Q2", 6)]))


@scenario("f string", [("f2",)])
def picked_filings(t):
    values = t("f string, status string, value double", [("f1", "verified", 1), ("f2", "held", -1), (None, "held", -1)])
    return selectors.picked(values, {"negative": c("value") < 0, "held": c("status") == "held"}, "negative", "f")


@scenario("f string", [("report",)])
def beside_charts(t):
    rows = [(2026, "Q3", "slides", "chart", "verified"), (2026, "Q3", "report", "ai", "held"), (2026, "Q2", "other", "ai", "held"), (2026, "Q1", "s", "chart", "rejected"), (2026, "Q1", "r", "ai", "held")]
    return selectors.beside_charts(t("y int, p string, f string, method string, status string", rows), ["y", "p"], "f", c("method") == "chart")


@scenario("tbl string, segment string", [("AM", "Asset Management")])
def segment_pages(t):
    rows = [("f", "AM", 1, "Discretionary assets", 50), ("f", "AM", 2, "Net income", 7), ("f", "AM", 3, "Only here", 1), ("f", "all", 1, "Discretionary assets", 210), ("f", "all", 2, "Net income", 7)]
    return selectors.of_segment_pages(t("f string, tbl string, row int, label string, value double", rows), t("f string, tbl string, segment string", [("f", "AM", "Asset Management"), ("f", "all", None)]), ["f"])


@scenario("item string, tbl string, row int", [("other", "IS", 8)])
def statement_others(t):
    readings = [("f", "other", "All other", "detail", 7), ("f", "cards", "Card fees", "detail", 7), ("f", "there", "Other", "IS", 7), ("f", "far", "Other", "detail", 40)]
    rows = [("f", "IS", 8, "Other", True), ("f", "IS", 20, "Other", True), ("f", "IS", 7, "Card fees", True), ("f", "detail", 3, "All other", False)]
    return selectors.statement_others(t("f string, item string, label string, tbl string, near_row int", readings), t("f string, tbl string, row int, label string, is_statement boolean", rows), ["f"])


@scenario("item string, flag string", [("moved", "differs"), ("gone", "no_cell"), ("bare", "no_locator")])
def audited_figures(t):
    cells = t(_CELLS, _cells("T1", [["", "2025"], ["Net sales", "$5"]]))
    items = [("f", "right", "T1", 1, 1, 1e6, 5e6), ("f", "moved", "T1", 1, 1, 1e6, 6e6), ("f", "gone", "T1", 9, 1, 1.0, 5.0), ("f", "bare", None, None, None, None, 5.0)]
    return selectors.audited_figures(t("f string, item string, tbl string, row int, col int, scale double, value double", items), cells, ["f"])


@scenario("k string, how string", [("a", "table"), ("b", "quote"), ("c", "tag"), ("d", "other")])
def reading_patterns(t):
    rows = [("a", "verified", "ai", None, None, "T1"), ("b", "verified", "ai", None, "q", None), ("c", "verified", "ai", "C", "q", None), ("d", "verified", "ai", None, None, None), ("e", "held", "ai", None, None, "T1"), ("f", "verified", "xbrl", "C", None, None)]
    return selectors.reading_patterns(t("k string, status string, method string, concept string, quote string, tbl string", rows), ["k"])


@scenario("g string, items string", [("a", "z,x,y")])
def members_by_size(t):
    return selectors.by_size(t("g string, k string, v double", [("a", "x", 5), ("a", "z", 9), ("a", "y", 5)]), ["g"], "v", "k").withColumn("items", F.array_join("items", ","))


@scenario("s string, predecessor string", [("GOOG", "Google Inc."), ("KHC", "Kraft"), ("KHC", "Heinz")])
def predecessor_registrants(t):
    return selectors.predecessors(t("s string", [("GOOG",), ("KHC",), ("MSFT",)]), {"GOOG": ["Google Inc."], "KHC": ["Kraft", "Heinz"]}, "s")


@scenario("s string, line string", [("a", '{"s":"a","n":1,"lines":[1.5]}'), ("b", '{"s":"b","lines":[]}')])
def reading_lines(t):
    return selectors.json_lines(t("s string, n int, lines array<double>", [("a", 1, [1.5]), ("b", None, [])]), ["s"])


@scenario("k string, v double", [("b", 7), ("new", 1)])
def held_writes(t):
    schema = "k string, v double"
    return selectors.batch_writes([t(schema, [("a", 1), ("b", 2)]), t(schema, [("a", 9), ("b", 3), ("new", 1)]), t(schema, [("a", 1), ("b", 7)])], ["k"], ["v"])


QUERIES = {k: scenarios.QUERIES[k] for k in scenarios.QUERIES if k not in _before}
SQL = {k: scenarios.SQL[k] for k in QUERIES}
