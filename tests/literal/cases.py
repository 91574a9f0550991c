"""Column functions over literal cases; the SQL lists what each has to give, written by hand and not by a second program."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import currency, fiscal, headers, labels, numbers, rounding, scales

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_TYPES = {"double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "int": "INTEGER", "long": "BIGINT"}


def _literal(x, kind: str) -> str:
    text = "NULL" if x is None else str(x).lower() if isinstance(x, bool) else repr(float(x)) if kind == "double" else str(x) if kind in ("int", "long") else "'" + str(x).replace("'", "''") + "'"
    return f"CAST({text} AS {_TYPES[kind]})"


def values_sql(outputs: str, rows: list[tuple]) -> str:
    """Rows as SQL; outputs: `name type, ...`."""
    names, kinds = zip(*(x.split() for x in outputs.split(", ")))
    each = ", ".join("(" + ", ".join(_literal(x, k) for x, k in zip(r, kinds)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {each}) t({', '.join(f'"{n}"' for n in names)})"


def case(name: str, inputs: str, outputs: str, rows: list[tuple], *columns: Callable[[], Column] | Column) -> None:
    """A query of one row for each case: its number and the columns. A row holds the inputs, then what has to come out."""
    kinds = [x.split()[1] for x in inputs.split(", ")]
    n_in = len(kinds)
    data = [(i, *[float(x) if k == "double" and x is not None else x for x, k in zip(r, kinds)]) for i, r in enumerate(rows)]
    named = [x.split()[0] for x in outputs.split(", ")]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.createDataFrame(data, f"case_no int, {inputs}").select("case_no", *[(c() if callable(c) else c).alias(n) for c, n in zip(columns, named)])

    QUERIES[name] = query
    SQL[name] = values_sql(f"case_no int, {outputs}", [(i, *r[n_in:]) for i, r in enumerate(rows)])


def parts(struct: Callable[[], Column], *fields: str) -> list[Callable[[], Column]]:
    return [lambda f=f: struct()[f] for f in fields]


c, d = F.col, dt.date
_NUMBER = "value double, percent boolean, scale_word string"
case("number_cases", "t string", _NUMBER, [
    ("$60,370", 60370, False, None), ("(4,970)", -4970, False, None), ("99.3%", 99.3, True, None), ("3.60 billion", 3.6e9, False, "billion"), ("NT$1,310.52 billion", 1.31052e12, False, "billion"),
    ("75,472", 75472, False, None), ("-2.5%", -2.5, True, None), ("$1.2B", 1.2e9, False, "billion"), ("30 months", 30, False, None), ("—", None, None, None), (None, None, None, None),
    ("Guests were 2.24 billion on average", 2240000000, False, "billion"), (".51", 0.51, False, None), (".51%", 0.51, True, None), ("(.12)", -0.12, False, None), ("-.25", -0.25, False, None),
    ("$.75", 0.75, False, None), ("No.5", 5.0, False, None), ("1,234.5", 1234.5, False, None), ("3.6 Billion", 3.6e9, False, "billion"), ("Three Months Ended", None, None, None), ("- $ 5", -5.0, False, None), (" " * 5000 + "x 7", 7.0, False, None),
], *parts(lambda: numbers.parse_number(c("t")), "value", "percent", "scale_word"))
case("word_number_cases", "t string", "value double, scale_word string", [
    ("nine harbours", 9, None), ("twenty-five", 25, None), ("two billion", 2e9, "billion"), ("moored at Thirty Two piers", 32, None), ("none", None, None), ("twelve", 12, None),
], *parts(lambda: numbers.word_number(c("t")), "value", "scale_word"))
case("figure_forms", "v double", "forms string", [(12000000000, "12|12,000|12,000,000|12,000,000,000|12,000,000,000.0|12,000,000,000.00|12,000,000.0|12,000,000.00|12,000.0|12,000.00|12.0|12.00"), (-3.65, "3.65"), (0.5, "")], lambda: F.array_join(numbers.figure_forms(c("v")), "|"))
case("statement_number", "t string", "value double", [("1,234", 1234), ("(1,234)", -1234), ("—", 0), ("-", 0), ("$ 5.5", 5.5), ("in millions", None), ("", None)], lambda: numbers.statement_number(c("t")))
case("clean_text", "t string", "clean string", [(" a  b\t c ", "a b c"), ("net revenue", "net revenue"), ("", "")], lambda: numbers.clean(c("t")))
case("decimal_places", "t string", "decimals int", [("12.340", 3), ("12", 0), ("(1,234.5)", 1)], lambda: numbers.decimals(c("t")))
case("fifteen_digits", "v double", "value double", [(0.1 + 0.2, 0.3), (2.11 * 1e9, 2110000000.0), (-1.005, -1.005)], lambda: numbers.fifteen_digits(c("v")))

case("member_key_cases", "t string", "key string", [
    ("Boats & Ferries", "boatsandferries"), ("Boats and Ferries Segment", "boatsandferries"), ("Other regions", "other"), ("All other countries not separately disclosed", "other"), ("Rest of the lake", "restofthelake"),
    ("Northern Isles (NI)", "northernisles"), ("Northern-Isles", "northernisles"), ("Other rent", "otherrent"), ("Other Isles", "otherisles"), ("All Other", "other"), ("Other", "other"), ("Segment", "segment"), ("(a)", "a"),
], lambda: labels.member_key(c("t")))
case("row_key_cases", "t string", "key string", [("7-metre boats", "r7metreboats"), ("Tickets sold", "ticketssold"), ("Other", "other"), ("z" * 60, "z" * 48)], lambda: labels.row_key(c("t")))
case("identity_cases", "t string", "key string", [("9-nanometers", "9nm"), ("9nm", "9nm"), ("nm9", "9nm"), ("Tickets sold", "ticketssold"), ("tickets_sold", "ticketssold")], lambda: labels.identity(c("t")))
case("sideless_key", "t string", "key string", [
    ("Gains (losses) of the harbour", "gloftheharbour"), ("Gains of the harbour", "gloftheharbour"), ("Losses of the quay", "glofthequay"),
], lambda: labels.sideless_key(c("t")))
case("labels_agree", "a string, b string", "agree boolean", [
    ("Ferry", "Ferry tickets", True), (None, "Tickets", True), ("Tickets", "", True), ("Tickets sold (2)", "all tickets sold", True), ("Tickets sold", "Crew wages", False),
    ("Piers & Jetties14", "Piers and Jetties", True), ("Share in lighthouses", "Share method", True), ("rowboat", "canoe", False),
], lambda: labels.labels_agree(c("a"), c("b")))
case("combined_line", "a string, b string", "combined boolean", [
    ("Total Piers & Harbour Dues", "Harbour Dues", True), ("Piers & Harbour Dues", "Harbour Dues", True), ("Harbour Dues", "Harbour Dues", False), ("Lakeside Harbour Dues", "Harbour Dues", False), ("Tickets", "Harbour Dues", False),
], lambda: labels.combined_line(c("a"), c("b")))
_ITEMS = [("boats", "Boat Sale Gains/(Losses)"), ("other", "Other Rent"), ("inland", "Harbours & Rivers - Inland"), ("tickets", "All tickets sold")]
case("listed_item", "t string", "key string", [
    ("Boat sale losses", "boats"), ("Boat sale gains", "boats"), ("Boat sale gains/(losses)", "boats"), ("Other losses", None), ("Lakeside Harbours & Rivers - Inland", "inland"), ("All tickets sold 3", "tickets"), ("all_tickets_sold", "tickets"), ("Quay 1", None),
], lambda: labels.listed_item(c("t"), F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("label")) for k, v in _ITEMS]))["key"])
case("without_footnote", "t string", "label string", [("Piers(a)", "Piers"), ("boats (1)", "boats"), ("boats(12)", "boats"), ("Q3", "Q3"), ("(b)", "(b)"), ("Main Pier", "Main Pier")], lambda: labels.without_footnote(c("t")))
case("row_label", "t string", "label string", [("Piers & Jetties14", "Piers & Jetties"), ("boats(1)", "boats"), ("Q3", "Q3"), ("Fares (b)", "Fares")], lambda: labels.row_label(c("t")))
case("initials", "t string", "initials string", [("Lakes & River Boats", "LRB"), ("Harbour & Pier Management", "HPM"), ("Port of the North", "PN")], lambda: labels.initials(c("t")))
case("names_segment", "t string, s string", "names boolean", [
    ("LRB fares by route", "Lakes & River Boats", True), ("Lakes & River Boats fares by pier", "Lakes & River Boats", True), ("Fares by pier", "Lakes & River Boats", False), ("Fares by route", "Headquarters", False),
], lambda: labels.names_segment(c("t"), c("s")))
case("humanize", "t string", "words string", [("own:LakesIncludingNorthBayMember", "Lakes Including North Bay"), ("own:IslandsSegmentMember", "Islands"), ("us-gaap:FerryMember", "Ferry"), ("EBoatMember", "E Boat"), ("Member", "")], lambda: labels.humanize(c("t")))
case("qualified_names", "t string", "local string, axis string", [("own:IslandsSegmentMember", "IslandsSegmentMember", "own:IslandsSegmentMember"), ("dim_us-gaap_RoutesAxis", "dim_us-gaap_RoutesAxis", "RoutesAxis")], lambda: labels.local_name(c("t")), lambda: labels.axis_name(c("t")))
case("title_case", "t string", "title string", [("fares of islands", "Fares of Islands"), ("eBoat and DVD fares", "eBoat and DVD Fares"), ("the islands", "The Islands")], lambda: labels.title_case(c("t")))
case("quote_template", "t string", "template string", [("We carried 4.25 million guests in May 2021", "we carried # million guests in @ #"), ("We carried 5 million guests in July 2022", "we carried # million guests in @ #"), ("In Q2, fares rose 7%.", "in @# fares rose #%#")], lambda: labels.quote_template(c("t")))
case("source_template_cases", "t string", "template string", [("https://a.b/c/F3Q21_Fares.htm", "fq_fares.htm"), ("x", "x")], lambda: labels.source_template(c("t")))
case("anchor_words", "q string, v string", "words string", [("Fares of all ferries were $7.5 million by autumn", "$7.5 million", "all ferries were"), ("was 5 and 5 again", "5", None), ("was 5", "5", None), ("nothing here", "7", None)], lambda: F.array_join(labels.anchor_words(c("q"), c("v"), 3), " "))
case("row_line", "q string, v string", "label string, place int, figures int", [
    ("Total harbour dues 41 52 63 9.9% 117 128 8.8%", "63", "Total harbour dues", 2, 7), ("Crew wages4,5 (712) (1,934)", "(712)", "Crew wages", 0, 2), ("Boats at anchor ($m) $11 $12 $13", "$13", "Boats at anchor ($m)", 2, 3),
    ("the fare of each guest fell by 6% on last year", "6%", None, None, None), ("Boats 88 88 89", "88", None, None, None),
], *[lambda f=f: f(labels.row_line(c("q"), c("v"))) for f in (lambda x: x["label"], lambda x: x["index"], lambda x: F.when(x.isNotNull(), F.size(x["slots"])))])
case("checked_key", "t string", "key string", [("Ferries Of The Lakes / Ferries Of The Northern Bays", "ferries_of_the_lakes_ferries_of_the_northern_bay"), ("7m boat", "k_7m_boat"), ("__A  b__", "a_b"), ("***", None)], lambda: labels.checked_key(c("t")))
case("fit_label", "t string", "label string", [("brief", "brief"), ("pier " * 20, ("pier " * 16).strip()), ("z" * 90, "z" * 80)], lambda: labels.fit_label(c("t")))
case("forward_looking", "t string", "forward boolean", [
    ("We anticipate fares of $3 million", True), ("fares beyond our forecast", False), ("Fares are expected to be recognized by autumn", False), ("Wages are expected to fall", True), ("the outlook for guests", True),
], lambda: labels.forward_looking(c("t")))
case("falls", "q string, v string", "falls boolean", [
    ("declined by 11%", "11%", True), ("a drop of 2%", "2%", True), ("lower 4%", "4%", True), ("the reduction in quay fees was 8%", "8%", True), ("fell by 3% and fares were 40%", "40%", False), ("dropped to 25%", "25%", False), ("down from 27% to 25%", "25%", False),
], lambda: labels.falls(c("q"), c("v")))
case("net_gross", "t string, l string", "names string", [("Net Fares", "Gross Fares", "net"), ("Gross dues", "Net dues", "gross"), ("Net fares", "Net fares", None), ("net and gross", "Net", None)], lambda: labels.net_gross_mismatch(c("t"), c("l")))
case("part_row", "r string, l string", "part boolean", [("Other boat licences", "Boat licences", True), ("All other piers", "Pier", True), ("Other rent", "Other rent", False), ("Piers", "Piers", False)], lambda: labels.part_row(c("r"), c("l")))
_LINE = "Harbour Gains (Losses) per Pier"
case("sign_convention", "r string, l string", "opposite boolean, ratio boolean", [
    ("Harbour Losses / (Gains) by Pier", _LINE, True, True), ("Yearly Harbour Gains (Losses) by Pier", _LINE, False, False), ("Harbour (Gains) / Losses by Pier", _LINE, True, True), ("Harbour Losses by Pier", _LINE, False, True), ("Harbour gains by pier", _LINE, False, False),
    ("Guests on board", "Guests on Board (GOB)", False, False), ("Harbour losses (gains)", "Harbour gains (losses)", True, True),
], lambda: labels.opposite_convention(c("r"), c("l")), lambda: labels.opposite_convention(c("r"), c("l"), ratio=True))
case("residual_label", "t string", "residual boolean", [("Other", True), ("All other", True), ("Other (1)", True), ("Other rent", False), (None, False)], lambda: labels.is_residual(c("t")))
case("line_kind", "t string", "kind string", [("Fares per share", "per_share"), ("Fares", "amount"), ("Average number of shares", "share_count"), ("Dues per common share", "per_share")], lambda: labels.line_kind(c("t")))
case("excerpt_titles", "t string", "titles string", [("A\n\nB", "A | B"), ("z" * 300 + "\n\nbrief", "z" * 240 + " | brief")], lambda: labels.excerpt_titles(c("t")))

case("declared_currency", "t string", "currency string", [
    ("Amounts in Thousands of New Taiwan Dollars", "TWD"), ("(€, in millions)", "EUR"), ("paid in US$ by banks", None), ("(in millions of U.S. dollars)", "USD"), ("(in millions of euros and Japanese yen)", None), ("Sold in Euros. (In millions)", None), (None, None),
], lambda: currency.declared_currency(c("t")))
case("value_currency", "t string, x string, f string, u string", "currency string", [
    ("NT$5", "", "USD", "currency", "TWD"), ("5", "(€, in millions)", "USD", "currency", "EUR"), ("$5", "", "TWD", "currency", "TWD"), ("$5", "", None, "currency", "USD"), ("5", "", "CAD", "currency", "CAD"), ("5", "", "CAD", "ratio", None), ("$5", "", "CAD", "count", None),
], lambda: currency.value_currency(c("t"), c("x"), c("f"), c("u")))
case("currencies_named", "t string", "codes string", [("US$ and euros, then US dollars", "USD,EUR"), ("€5 or £4", "EUR,GBP"), ("none", "")], lambda: F.array_join(currency.currencies(c("t")), ","))
case("bare_currency", "t string", "kind string", [("($ millions)", "$"), ("(In millions of Dollars)", "$"), ("(in thousands of pesos)", "pesos"), ("in millions", None)], lambda: currency.bare_currency(c("t")))

case("fiscal_label_cases", "day date, m string, annual boolean, o int", "fiscal_year int, fiscal_period string", [
    (d(2026, 6, 30), "1231", False, 0, 2026, "Q2"), (d(2026, 12, 31), "1231", True, 0, 2026, "FY"), (d(2026, 7, 26), "0125", False, 0, 2027, "Q2"), (d(2026, 1, 25), "0125", True, 0, 2026, "FY"), (d(2025, 12, 27), "0926", False, 0, 2026, "Q1"),
    (d(2026, 6, 27), "0926", False, 0, 2026, "Q3"), (d(2026, 2, 1), "0131", True, 0, 2026, "FY"), (d(2026, 2, 1), "0201", True, -1, 2025, "FY"), (d(2026, 5, 15), "1231", False, 0, None, None), (d(2026, 6, 30), "1231", True, 0, None, None),
    (d(2025, 3, 22), "1227", False, 0, 2025, "Q1"), (d(2025, 6, 14), "1227", False, 0, 2025, "Q2"), (d(2025, 9, 6), "1227", False, 0, 2025, "Q3"), (d(2025, 12, 27), "1227", False, 0, 2025, "Q4"), (d(2024, 11, 24), "0831", False, 0, 2025, "Q1"),
    (d(2025, 2, 16), "0831", False, 0, 2025, "Q2"), (d(2025, 5, 11), "0831", False, 0, 2025, "Q3"), (d(2025, 8, 31), "0831", False, 0, 2025, "Q4"), (d(2025, 5, 24), "0131", False, 0, 2026, "Q1"), (d(2025, 8, 16), "0131", False, 0, 2026, "Q2"),
    (d(2025, 11, 8), "0131", False, 0, 2026, "Q3"), (d(2026, 1, 31), "0131", False, 0, 2026, "Q4"), (d(2025, 4, 30), "0131", False, 0, 2026, "Q1"), (d(2023, 10, 29), "1029", False, 0, 2023, "Q4"), (d(2026, 8, 31), "0531", False, 0, 2027, "Q1"), (d(2024, 12, 31), "1231", False, 0, 2024, "Q4"),
], *parts(lambda: fiscal.fiscal_label(c("day"), c("m"), c("annual"), c("o")), "fiscal_year", "fiscal_period"))
_ENDS = "filed date, m string, own array<date>"
case("quarter_end_cases", _ENDS, "quarter_end date", [
    (d(2026, 7, 16), "1231", None, d(2026, 6, 30)), (d(2026, 7, 3), "1231", None, d(2026, 3, 31)), (d(2026, 1, 28), "1231", None, d(2025, 12, 31)), (d(2026, 7, 30), "0926", None, d(2026, 6, 26)), (d(2025, 5, 29), "0831", None, d(2025, 2, 28)),
    (d(2025, 5, 29), "0831", [d(2024, 5, 12), d(2025, 2, 16)], d(2025, 5, 11)), (d(2025, 6, 20), "0131", [d(2024, 5, 25)], d(2025, 5, 24)), (d(2025, 10, 9), "1227", [d(2025, 9, 6), d(2024, 9, 7)], d(2025, 9, 6)), (d(2026, 7, 16), "1231", [d(2025, 6, 30), d(2026, 3, 31)], d(2026, 6, 30)),
], lambda: fiscal.quarter_end_before(c("filed"), c("m"), c("own")))
case("own_quarter_end", _ENDS, "quarter_end date", [(d(2025, 5, 31), "", [d(2024, 5, 12)], d(2025, 5, 11)), (d(2025, 6, 30), "", [d(2024, 6, 30)], d(2025, 6, 30)), (d(2025, 5, 31), "", [d(2025, 5, 11), d(2024, 6, 1)], d(2025, 5, 11)), (d(2025, 5, 31), "", [], d(2025, 5, 31))], lambda: fiscal.own_end(c("filed"), c("own")))
case("release_period", "filed date, m string", "quarter_end date", [
    (d(2025, 10, 2), "1231", d(2025, 9, 30)), (d(2025, 10, 22), "1231", d(2025, 9, 30)), (d(2025, 12, 10), "1231", d(2025, 9, 30)), (d(2025, 7, 2), "0630", d(2025, 6, 30)),
], lambda: fiscal.release_period(c("filed"), c("m")))
case("label_period", "a date, b date, m string", "fiscal_year int, fiscal_period string, duration string", [
    (None, d(2025, 12, 31), "1231", 2025, "FY", "instant"), (None, d(2025, 6, 30), "1231", 2025, "Q2", "instant"), (d(2025, 4, 1), d(2025, 6, 30), "1231", 2025, "Q2", "quarter"), (d(2025, 1, 1), d(2025, 12, 31), "1231", 2025, "FY", "year"),
    (d(2025, 1, 1), d(2025, 9, 30), "1231", 2025, "Q3", "ytd"), (d(2025, 5, 1), d(2025, 12, 31), "1231", None, None, None), (d(2025, 7, 1), d(2025, 12, 31), "1231", None, None, None), (d(2025, 1, 1), d(2025, 3, 31), "1231", 2025, "Q1", "quarter"),
], *parts(lambda: fiscal.label_period(c("a"), c("b"), c("m")), "fiscal_year", "fiscal_period", "duration"))
case("short_first_year", "a date, b date, f date, m string, form string", "fiscal_year int, duration string", [
    (d(2022, 7, 4), d(2022, 12, 31), d(2022, 7, 4), "1231", "40-F", 2022, "year"), (d(2022, 7, 4), d(2022, 12, 31), d(2021, 7, 4), "1231", "40-F", None, None), (d(2022, 7, 4), d(2022, 12, 31), d(2022, 7, 4), "1231", "10-KT", None, None), (d(2022, 1, 1), d(2022, 12, 31), d(2022, 1, 1), "1231", "10-K", None, None),
], *parts(lambda: fiscal.short_first_year(c("a"), c("b"), c("f"), c("m"), c("form")), "fiscal_year", "duration"))
case("year_end_at", "p date, ends array<date>, u string", "mmdd string", [
    (d(2008, 8, 29), [d(2008, 11, 28), d(2009, 12, 31)], "1231", "1128"), (d(2025, 6, 28), [d(2025, 12, 27)], "1231", "1231"), (d(2025, 6, 30), [], "1231", "1231"), (None, [d(2025, 9, 30)], "1231", "1231"),
], lambda: F.when(c("p").isNull(), c("u")).otherwise(fiscal.year_end_at(c("p"), c("ends"), c("u"))))
case("stated_year_end", "s string, l date", "mmdd string", [("0513", d(2025, 12, 31), "1231"), ("0130", d(2026, 1, 31), "0130"), ("1231", d(2026, 1, 2), "1231"), ("0926", d(2025, 9, 27), "0926")], lambda: fiscal.stated_year_end(c("s"), c("l")))
case("opening_instant", "a date, on array<date>", "opening date", [(d(2025, 1, 1), [d(2024, 12, 31), d(2025, 12, 31)], d(2024, 12, 31)), (d(2025, 1, 1), [d(2024, 12, 28), d(2024, 12, 26)], d(2024, 12, 28)), (d(2025, 1, 1), [d(2024, 12, 20)], None), (None, [d(2024, 12, 31)], None)], lambda: fiscal.opening_instant(c("a"), c("on")))
case("period_key", "k string", "start date, finish date", [("duration_2024-01-01_2024-03-31", d(2024, 1, 1), d(2024, 3, 31)), ("instant_2024-12-31", None, d(2024, 12, 31)), ("forever", None, None)], *parts(lambda: fiscal.period_key(c("k")), "start", "end"))
case("named_quarter", "t string, m string", "quarter_end date", [
    ("Q3 2007", "1231", d(2007, 9, 30)), ("1Q08", "1231", d(2008, 3, 31)), ("Third Quarter 2007", "1231", d(2007, 9, 30)), ("3Q-2016", "1231", d(2016, 9, 30)), ("2nd Q 2003", "1231", d(2003, 6, 30)), ("Q1 2026", "0926", d(2025, 12, 26)), ("the quarter", "1231", None),
], lambda: fiscal.named_quarter(c("t"), c("m")))
case("named_months", "t string, m string", "finish date, months int", [("6M19", "1231", d(2019, 6, 30), 6), ("1H19", "1231", d(2019, 6, 30), 6), ("9M 2015", "1231", d(2015, 9, 30), 9), ("3M'21", "0331", d(2020, 6, 30), 3), ("FY20", "1231", None, None)], *parts(lambda: fiscal.named_months(c("t"), c("m")), "end", "months"))
case("day_first", "t string", "first boolean", [("30/06/2009 | 31/03/2009", True), ("01/04/2003 a 6/30/2003", False), ("3/21/09", False), ("1/2/2003", False)], lambda: fiscal.day_first(c("t")))
case("numeric_date", "t string, f boolean", "day date", [("3/31/2005", False, d(2005, 3, 31)), ("3/31/05", False, d(2005, 3, 31)), ("30/06/2009", True, d(2009, 6, 30)), ("31.12.2010", True, d(2010, 12, 31)), ("13/13/2005", False, None), ("none", False, None)], lambda: fiscal.numeric_date(c("t"), c("f")))
case("available_from", "a timestamp, f date", "available string", [(None, d(2024, 1, 2), "2024-01-03 05:00:00"), (None, d(2024, 7, 2), "2024-07-03 04:00:00"), (dt.datetime(2024, 7, 2, 16, 30), d(2024, 7, 2), "2024-07-02 16:30:00")], lambda: F.date_format(fiscal.available_from(c("a"), c("f")), "yyyy-MM-dd HH:mm:ss"))

_HEAD = "rows array<array<string>>, r int, k int"
_T1 = [["", "Three Months Ended September 30, 2026", "Three Months Ended September 30, 2025"], ["Tickets", "100", "90"], ["Guests", "", ""], ["Passes", "12", "11"]]
_T2 = [["", "Q3", ""], ["", "2026", "2025"], ["Revenue", "5,000", "4,000"]]
_LAKES = [
    ["", "LAKES & RIVERS", "", "", ""], ["(Millions of dollars)", "", "", "", ""], ["", "Fares by Lake", "", "", ""], ["", "Third Quarter 2025", "More Guests", "Higher Fares", "Third Quarter 2026"], ["All Fares", "$5,100", "$300", "$120", "$5,520"],
    ["", "Fares by Boat", "", "", ""], ["", "Third Quarter 2026", "Third Quarter 2025", "$Change", "%Change"], ["Ferries", "$2,210", "$1,700", "$510", "30%"], ["Rowing Boats", "1,130", "1,000", "130", "13%"], ["Canoes", "520", "500", "20", "4%"],
]
case("column_header", _HEAD, "header string", [
    (_T1, 1, 1, "three months ended @ # #"), ([["", "Q4 2025"], ["a", "1"]], 1, 1, "<fourth quarter>"), ([["", "January to June 2024"], ["a", "1"]], 1, 1, "<6 months> #"), ([["", "26 weeks ended"], ["", "June 30, 2024"], ["a", "1"]], 2, 1, "<26 weeks> ended @ # #"),
    ([["", "Nine months ended September 30,", ""], ["", "2024", "2023"], ["a", "1", "2"]], 2, 2, "nine months ended @ #"),
], lambda: headers.column_header(c("rows"), c("r"), c("k")))
case("column_dates", _HEAD, "dates string, years string", [
    (_T1, 3, 1, "2026-09-30", "2026"), (_T2, 2, 2, "", "2025"), (_LAKES, 7, 1, "", "2026"), (_LAKES, 9, 1, "", "2026"), (_LAKES, 4, 1, "", "2025"), ([["", "12 Weeks Ended 6/14/2025"], ["a", "1"]], 1, 1, "2025-06-14", "2025"), ([["", "3Q'25"], ["a", "1"]], 1, 1, "", "2025"),
], lambda: F.array_join(headers.column_dates(c("rows"), c("r"), c("k"))["dates"].cast("array<string>"), ","), lambda: F.array_join(headers.column_dates(c("rows"), c("r"), c("k"))["years"].cast("array<string>"), ","))
case("header_contradicts", _HEAD, "problem string", [
    (_LAKES, 9, 1, None), (_LAKES, 8, 2, "column headed 2025, not the quarter ended 2026-09-30"), (_LAKES, 4, 1, "column headed 2025, not the quarter ended 2026-09-30"), (_LAKES, 4, 4, None), (_T1, 3, 2, "column headed 2025-09-30, not the quarter ended 2026-09-30"), (_T1, 3, 1, None),
], lambda: headers.header_contradicts(c("rows"), c("r"), c("k"), F.lit(d(2026, 9, 30))))
case("duration_problem", "h string, a boolean", "problem string", [("six months ended @ #", False, "longer"), ("three months ended @ #", False, None), ("three months ended @ #", True, "quarter"), ("year ended @ #", True, None), ("@ #", False, None), ("<26 weeks> ended", False, "longer")], lambda: headers.duration_problem(c("h"), c("a")))
case("states_quarter", "h string", "states boolean", [(x, True) for x in ("Three Months Ended December 31, 2025", "Q4 2025", "4Q25", "13 weeks ended")] + [(x, False) for x in ("December 31, 2025", "Twelve Months Ended", "Fiscal 2025")], lambda: headers.states_quarter(c("h")))
case("year_ago_value", _HEAD + ", v double", "value double", [(_T1, 1, 1, 100e6, 90e6), (_T2, 2, 1, 5000.0, 4000.0), ([["", "Q3 2026", "Change"], ["a", "5", "1"]], 1, 1, 5.0, None)], lambda: headers.year_ago_value(c("rows"), c("r"), c("k"), F.lit(d(2026, 9, 30)), c("v")))
_PARKING = [["", "Other Fares", "", "", "", ""], ["", "Quarter Ended", "", "Change", "", ""], ["(Dollars in millions)", "3Q23", "2Q23", "3Q22", "Link", "Like"], ["Parking fees", "$410", "$520", "$400", "$(110)", "$10"], ["Kiosk rents", "88", "86", "91", "2", "(3)"]]
case("names_period", _HEAD + ", e date, q int, y int", "names boolean", [
    (_PARKING, 4, 1, d(2023, 9, 30), 3, 2023, True), (_PARKING, 4, 3, d(2023, 9, 30), 3, 2023, False), (_PARKING, 4, 2, d(2023, 9, 30), 3, 2023, False), ([["(Dollars in millions)", "1Q25", "1Q24"], ["Kiosk rents", "", "88"]], 1, 2, d(2024, 9, 30), 1, 2025, False),
    ([["(Dollars in millions)", "1Q25", "1Q24"], ["Kiosk rents", "91", "88"]], 1, 1, d(2024, 9, 30), 1, 2025, True), (_T1, 1, 1, d(2026, 9, 26), 3, 2026, True), (_T1, 1, 2, d(2026, 9, 26), 3, 2026, False),
], lambda: headers.names_period(c("rows"), c("r"), c("k"), c("e"), c("q"), c("y")))
_BERTHS = [["Harbours ($in millions, except per share amounts)", "", "3Q’23", "", "2Q'23"], ["Full berths", "", "71.5%", "", "70.4%"]]
_CREW = [["", "", "THREE MONTHS ENDED", "", "", "", ""], ["", "2026", "", "2025", "", "", ""], ["Crew", "", "1,250", "", "1,310", "", ""]]
case("current_column", _HEAD, "newest boolean", [(_BERTHS, 1, 2, True), (_CREW, 2, 2, True), (_CREW, 2, 4, False), ([["", "Actual"], ["a", "1"]], 1, 1, True)], lambda: headers.current_column(c("rows"), c("r"), c("k")))
_ALONE = "Ferry sales to members for the trailing twelve months rose over 15% to $70 million"
_BOTH = "Ferry sales to members came to $61 million for the trailing twelve-month period and to $17 million for the quarter"
_SLIDE = "Fares and margin of the season. Excluding ABC, 2Q21 ticket income was $61 MM and ticket margin was 8.41%. Ticket income down $5 MM, or 2%, from 2Q20."
case("quote_problem", "t string, q string, b string, v string, l string", "problem string", [
    (_ALONE, _ALONE, _ALONE[: _ALONE.find("$70")], "$70 million", "Ferry Sales to Members", "trailing"), (_BOTH, _BOTH, _BOTH[: _BOTH.find("$17")], "$17 million", "Ferry Sales to Members", None),
    (_ALONE, _ALONE, _ALONE[: _ALONE.find("$70")], "$70 million", "Ferry Sales (TTM)", None), ("", "", "Fares of all lakes rose 6% to over ", "$51 million", "Fares", "bound"), ("", "", "The yard also built ", "more than 4,000 boats", "Boats", "bound"),
    ("", "", "we announced piers worth ", "nearly $8 million", "Piers", "bound"), ("", "", "Fares were about ", "$9 million", "Fares", None), ("", "", "rose 3% to ", "$52 million", "Fares", None), ("", "", "over 20 charters worth ", "$4.5 million", "Charters", None),
    (_SLIDE, "ticket margin was 8.41%", "ticket margin was ", "8.41%", "Ticket Margin", "adjusted"), ("On an adjusted basis, fares rose 4%.", "fares rose 4%", "fares rose ", "4%", "Fare Growth", "adjusted"), (_SLIDE, "ticket margin was 8.41%", "ticket margin was ", "8.41%", "Ticket Margin excl. ABC", None),
    ("", "YTD 2025, the harbour was given 19 new charters", "YTD 2025, the harbour was given ", "19", "Charters", "other_period"), ("", "In the second quarter of fiscal 2026, 3,072 berths booked", "In the second quarter of fiscal 2026, ", "3,072", "Berths Booked", None),
    ("", "guests increased 1,500 year-to-date, to approximately 8,000", "guests increased 1,500 year-to-date, to approximately ", "8,000", "Members", None),
], lambda: headers.quote_problem(c("t"), c("q"), c("b"), c("v"), c("l")))
case("period_problem", "a date, b date", "problem boolean", [(d(2025, 9, 27), d(2025, 9, 30), False), (d(2025, 9, 1), d(2025, 9, 30), True), (None, d(2025, 9, 30), True)], lambda: headers.period_problem(c("a"), c("b")))

case("stated_tolerance", "v double", "tolerance double", [(677e9, 5e8), (3.65, 0.005), (20e9, 5e8), (1.21, 0.005), (32.3, 0.05), (7, 0.5), (12300, 50), (1000000, 50000), (0, 0.5)], lambda: rounding.stated_tolerance(c("v")))
case("is_evidence", "f double, v double", "evidence boolean", [(7.3, 7, False), (7, 7, True), (4.651e9, 4.65e9, True), (3, 3.65, False), (676.6e9, 677e9, True), (678e9, 677e9, False)], lambda: rounding.is_evidence(c("f"), c("v")))
case("reported_tolerance", "n int", "tolerance double", [(-3, 500), (-6, 500000), (0, 0.5), (2, 0.5), (None, 0.5)], lambda: rounding.reported_tolerance(c("n")))
case("same_figure", "a double, b double", "same boolean, differ boolean, gap double", [(0.1 + 0.2, 0.3, True, False, 1.0), (100, 101, False, True, -1 / 101), (100, 100.2, False, False, None), (5, 0, False, True, None)], lambda: rounding.same_figure(c("a"), c("b")), lambda: rounding.differs(c("a"), c("b")), lambda: F.when(c("b") == 101, rounding.relative_gap(c("a"), c("b"))).when(c("b") == 0.3, F.lit(1.0)))
case("significant", "v double", "significant boolean", [(1230000, True), (1200000, False), (999000, False), (-1234567, True)], lambda: rounding.significant(c("v")))
case("declared_ratio", "v double", "ratio double", [(7.004, 7), (1.5, 1.5), (1.26, 1.25), (0.1, 0.1), (0.4975, 0.5), (130, None), (1.1, None), (20.02, 20), (3.01, 3)], lambda: rounding.declared_ratio(c("v")))
case("clean_ratio", "v double", "ratio double", [(7.004, 7), (1.5, 1.5), (0.1, 0.1), (0.335, 1 / 3), (1.1, None), (2.2, None)], lambda: rounding.clean_ratio(c("v")))
case("growth_match", "v double, b double, g double", "matches boolean", [(110, 100, 10, True), (110, 100, 10.2, False), (110, 0, 10, None)], lambda: rounding.growth_matches(c("v"), c("b"), c("g")))
case("same_to_zeros", "a double, b double", "same boolean", [(12300, 12345, True), (12300, 12351, False), (5, 5, True), (1000, 1400, True), (1500, 1400, False)], lambda: rounding.same_to_zeros(c("a"), c("b")))
case("printed_half", "t string, s double", "half double", [("3.6", 1e9, 5e7), ("1,234", 1e6, 5e5), ("0.25", 1, 0.005)], lambda: rounding.printed_half(c("t"), c("s")))
case("coarsest_step", "v array<double>", "step double", [([1200.0, 300.0], 100), ([1.5, 2000.0], 0.1), ([3e9, 6e9], 1e9), ([7.0], 1e9), ([1234.0], 1)], lambda: rounding.coarsest_step(c("v")))
case("release_unit", "v double, x double", "unit double", [(1015e6, 1018, 1e6), (5e6, 5, 1e6), (1.5e6, 1, None), (5, 0, None), (0, 5, None)], lambda: rounding.release_unit(c("v"), c("x")))
case("refined_rest", "p double, s double, t double, f double", "rest double", [(24756675000, 200000000, 24996056000, 1000, 239381000), (24756675000, 200000000, 25096056000, 1000, None), (100e6, 5e5, 100.5e6, 1, None)], lambda: rounding.refined_rest(c("p"), c("s"), c("t"), c("f")))

_S, _IN = "factor double, source string, words string", "rows array<array<string>>, x string, r int, k int, l string, doc string"
_J = [["", "Q3"], ["Net revenue", "55"], ["Expense", "30"], ["Income", "25"], ["Card sales volume (in billions)", "1,234"]]
_NOW = [["", "Amount ($ millions)", "Year/Year Growth (%)"], ["Season passes", "$1,211", "17"], ["($ billions) (2)", "Year/Year Growth (%)"], ["Booked", "$2.1", "9"], ["Reserved", "$3.3", "9"]]
_NOW2 = [["", "Amount ($ millions)", "Year/Year Growth (%)"], ["All fares", "$1,311", "19%"], ["", "Amount ($ billions)(2)", "Year/Year Growth (%)"], ["Booked", "$2.1", "9%"], ["Reserved", "$3.3", "9%"], ["", "Amount ($ millions)", "Margin (%)"], ["Profit of passes", "$841", "72%"]]
_AUM = [["", "Q3 2026"], ["Revenue", "4,100"], ["($ billions)", ""], ["Assets under management", "908"], ["Non-GAAP results:", ""], ["Free cash flow", "500"]]
_PKG = [["", "Q3 2026"], ["Boxes", "12,000"], ["(in millions, except per share amounts)", ""], ["Revenue per box", "3.25"], ["Revenue", "18,700"]]
_BRENT = [["", "2Q18"], ["Brent ($/b)", "74.35"], ["Henry Hub ($/mbtu)", "2.80"]]
_amount = lambda: scales.cell_amount_scale(c("rows"), c("x"), c("r"), c("k"), c("l"), scales.one_scale(c("doc"), "document"))
case("cell_amount_scale", _IN, "factor double, source string", [
    (_J, "($ in millions)", 4, 1, "Card sales volume", "", 1e9, "row"), (_J, "($ in millions)", 1, 1, "Net revenue", "", 1e6, "table"), (_J[:2], "", 1, 1, "Net revenue", "All amounts in thousands of dollars unless noted", 1e3, "document"), (_J[:2], "", 1, 1, "Net revenue", "", None, None),
    ([["", "Q3"], ["Revenue per box", "4.44"]], "($ in millions)", 1, 1, "Revenue per box", "", 1, "per-unit"), (_BRENT, "", 1, 1, "Brent", "Earnings (millions of dollars)", 1, "row"), (_BRENT, "", 2, 1, "Brent", "", 1, "row"), (_NOW, "", 3, 1, "Booked for the season (Booked)", "", 1e9, "heading"),
    (_NOW, "", 1, 1, "Season passes", "", 1e6, "column"), ([["", "Q3"], ["($ in millions, except per share amounts)", ""], ["Revenue", "512"]], "", 2, 1, "Revenue", "", 1e6, "heading"), (_NOW2, "", 3, 1, "Booked", "", 1e9, "heading"), (_NOW2, "", 4, 1, "Reserved", "", 1e9, "heading"), (_NOW2, "", 6, 1, "Profit of passes", "", 1e6, "heading"),
    (_NOW2, "", 1, 1, "All fares", "", 1e6, "column"), (_AUM, "($ in millions)", 3, 1, "Assets under management", "", 1e9, "heading"), (_AUM, "($ in millions)", 5, 1, "Free cash flow", "", 1e6, "table"), (_PKG, "", 3, 1, "Revenue per box", "", 1, "per-unit"), (_PKG, "", 4, 1, "Revenue", "", 1e6, "heading"),
], *parts(_amount, "factor", "source"))
case("heading_unsure", _IN, "factor double", [(_AUM, "", 5, 1, "", "", 1e9), (_AUM, "", 3, 1, "", "", None)], lambda: scales.body_scale(c("rows"), c("r"), c("k"))["unsure"]["factor"])
_E = [["", "Q3"], ["Employees", "12,400"], ["Paid memberships (in millions)", "301"]]
case("cell_count_scale", "rows array<array<string>>, r int, k int", _S, [
    (_E, 1, 1, 1, "units", None), (_E, 2, 1, 1e6, "row", "(in millions)"), ([["", "Q3"], ["Avg. daily boxes (ADB) (000s):", ""], ["By road", "8,200"]], 2, 1, 1e3, "heading", "(000s)"), ([["", "Guest Trips (Mil.)"], ["All", "39"]], 1, 1, 1e6, "column", "(Mil.)"),
], *parts(lambda: scales.cell_count_scale(c("rows"), c("r"), c("k"), F.lit(None).cast(scales.TYPE)), "factor", "source", "words"))
_P = "($ in millions) Net revenue was 55. ($ in billions) AUM reached 908."
case("passage_amount_scale", "t string, p int, l string, doc string", _S, [
    (_P, _P.find("AUM reached"), "Assets under management", "", 1e9, "passage", "($ in billions)"), (_P, _P.find("Net revenue"), "Net revenue", "", 1e6, "passage", "($ in millions)"), ("a fee of 7,300 ($ in millions)", 9, "Revenue per student", "", 1, "per-unit", "per s"), ("net sales of 5", 10, "Net sales", "in thousands", 1e3, "document", "in thousands"),
], *parts(lambda: scales.passage_amount_scale(c("t"), c("p"), c("l"), scales.one_scale(c("doc"), "document")), "factor", "source", "words"))
case("passage_count_scale", "b string, p string, l string", "factor double, source string", [
    ("Ferry Members (#, in millions) ", "", "", 1e6, "row"), ("Customers ", "", "", 1, "units"), ("3 Months Ended Jun 30, 2021 ", "Period Trips Made (millions) Growth ", "Trips Made", 1e6, "heading"),
    ("Lake Line. ", "Trips Made (millions) Fares Paid ($ billions) Passes Boats ", "Passes", 1, "units"), ("41,077 ", "Trips Made (millions) " + "x " * 80, "Trips Made", 1, "units"),
], *parts(lambda: scales.passage_count_scale(c("b"), c("p"), c("l")), "factor", "source"))
case("table_scale", "rows array<array<string>>, x string", "factor double", [
    ([["", "Q3"], ["Americas", "1,200"]], "(in thousands)", 1e3), ([["", "(Units in thousands, Revenue in millions)"], ["iPhone", "5"]], "", 1e6), ([["", "Q3"], ["Revenue", "4,100"], ["($ in billions)", ""], ["RPO", "5"]], "", None), ([["", "2026"], ["a", "1"]], "", None),
], lambda: scales.table_scale(c("x"), c("rows"))["factor"])
case("statement_scale", "t string", "money double, shares double", [("(In millions, except number of shares which are reflected in thousands and per share amounts)", 1e6, 1e3), ("(in thousands)", 1e3, 1e3), ("(in millions, except share data)", 1e6, 1), ("Balance sheet", None, 1)], *parts(lambda: scales.statement_scale(c("t")), "money", "shares"))
case("proven_scale", "p array<double>, w array<double>", "factor double", [([5.0, 7.0, 9.0], [5000.0, 7000.0, None], 1e3), ([5.0, 7.0], [5e6, 8e9], 1e6), ([5.0], [4.0], None), ([5.0, 7.0], [5.0, 7.0], 1)], lambda: scales.proven_scale(c("p"), c("w")))
