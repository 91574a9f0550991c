"""Integrity checks. A check gives findings and changes no row; nothing to check is never a pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Tolerances of the checks.
PARTS_TOLERANCE, MIX_POINTS, TOTAL_MATCH, DERIVED_GAP = 0.01, 2.5, 0.001, 0.001


def outcome(fails: Column, passes: Column) -> Column:
    """fail, pass or none: what can't be judged is none."""
    return F.when(fails, "fail").when(passes, "pass").otherwise("none")


def parts_vs_total(parts: DataFrame, totals: DataFrame, keys: list[str], part: str, total: str, tolerance: float = PARTS_TOLERANCE) -> DataFrame:
    """(keys, parts_sum, total, error, result): sums of parts against totals; a total of null or 0 gives none."""
    sums = parts.groupBy(*keys).agg(F.sum(part).alias("parts_sum"))
    both = totals.select(*keys, F.col(total).alias("total")).join(sums, keys, "left")
    error = F.abs(F.col("parts_sum").cast("double") - F.col("total").cast("double")) / F.nullif(F.abs(F.col("total").cast("double")), F.lit(0.0))
    return both.withColumn("error", error).withColumn("result", outcome(F.col("error") > tolerance, F.col("error") <= tolerance))


def mix_to_100(df: DataFrame, keys: list[str], share: str, points: float = MIX_POINTS) -> DataFrame:
    """(keys, shares_sum, result): shares between 0 and 100 that add up to 100 within some points."""
    agg = df.groupBy(*keys).agg(F.sum(share).alias("shares_sum"), F.bool_and(F.col(share).between(0, 100)).alias("_inside"))
    ok = F.col("_inside") & (F.abs(F.col("shares_sum") - 100) <= points)
    return agg.withColumn("result", outcome(~ok, ok)).drop("_inside")


def shared_cells(df: DataFrame, cell: list[str], item: str) -> DataFrame:
    """Cells that more than one item was read from, with how many."""
    return df.groupBy(*cell).agg(F.count_distinct(item).cast("long").alias("items")).where("items > 1")


def off_rows(df: DataFrame, keys: list[str], row: str) -> DataFrame:
    """Rows of a group that aren't on the row most of the group is on, ties to the lowest."""
    n = df.groupBy(*keys, row).agg(F.count("*").alias("_n"))
    usual = n.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(row).alias("usual_row"))).alias("_m")).select(*keys, F.col("_m.usual_row"))
    return df.join(usual, keys).where(F.col(row) != F.col("usual_row"))


def balances(assets: Column, claims: Column, tolerance: Column) -> Column:
    return outcome(F.abs(assets - claims) > tolerance, F.abs(assets - claims) <= tolerance)


def rolls(opening: Column, change: Column, closing: Column, effect: Column, tolerance: Column) -> Column:
    """Opening and change give closing, with or without the effect of exchange."""
    without, with_ = F.abs(opening + change - closing), F.abs(opening + change + F.coalesce(effect, F.lit(0.0)) - closing)
    return outcome((without > tolerance) & (with_ > tolerance), (without <= tolerance) | (with_ <= tolerance))


def weighted_sum(arcs: DataFrame, facts: DataFrame, keys: list[str], tolerance: Column | float) -> DataFrame:
    """Calculation arcs (parent, child, weight) over facts (keys, concept, value): a parent with a missing child gives none."""
    child = facts.select(*keys, F.col("concept").alias("child"), F.col("value").alias("_child"))
    parent = facts.select(*keys, F.col("concept").alias("parent"), F.col("value").alias("_total"))
    rows = parent.join(arcs, "parent").join(child, [*keys, "child"], "left")
    agg = rows.groupBy(*keys, "parent").agg(F.first("_total").alias("total"), F.sum(F.col("_child") * F.col("weight")).alias("computed"), F.bool_or(F.col("_child").isNull()).alias("_open"))
    tolerance = F.lit(tolerance) if isinstance(tolerance, float) else tolerance
    gap = F.abs(F.col("computed") - F.col("total"))
    return agg.withColumn("result", F.when(F.col("_open"), "none").otherwise(outcome(gap > tolerance, gap <= tolerance))).drop("_open")


def coded_tree(df: DataFrame, keys: list[str], code: str, value: str, tolerance: float) -> DataFrame:
    """Codes with dots: each code's children against itself. (keys, code, total, children, result)."""
    up = F.regexp_extract(F.col(code), r"^(.*)\.[^.]+$", 1)
    sums = df.withColumn("_up", up).where("_up <> ''").groupBy(*keys, F.col("_up").alias(code)).agg(F.sum(value).alias("children"))
    gap = F.abs(F.col("total") - F.col("children"))
    return df.select(*keys, code, F.col(value).alias("total")).join(sums, [*keys, code]).withColumn("result", outcome(gap > tolerance, gap <= tolerance))


def flag_group(keys: list[str], bad: Column) -> Column:
    """Whole or nothing: one bad row makes its whole group bad."""
    return F.bool_or(bad).over(Window.partitionBy(*keys))


@dataclass(frozen=True)
class Check:
    """Rows for which `bad` holds are findings, among rows of the declared kinds and methods."""

    name: str
    bad: Column
    kinds: tuple[str, ...] = ()
    methods: tuple[str, ...] = ()


def findings(df: DataFrame, keys: list[str], checks: list[Check]) -> DataFrame:
    """(keys, check) for each finding, in one pass: all checks are tested on a row before it is repeated."""
    tests = []
    for c in checks:
        applies = F.lit(True)
        if c.kinds:
            applies = applies & F.col("group_kind").isin(*c.kinds)
        if c.methods:
            applies = applies & F.col("method").isin(*c.methods)
        tests.append(F.when(applies & c.bad, F.lit(c.name)))
    return df.select(*keys, F.explode(F.array_compact(F.array(*tests))).alias("check"))


def status(results: list[Column]) -> Column:
    """kept if some check passes and none fails, rejected if one fails, else unproven."""
    any_ = lambda v: reduce(lambda a, b: a | b, [F.coalesce(r == v, F.lit(False)) for r in results])
    return F.when(any_("fail"), "rejected").when(any_("pass"), "kept").otherwise("unproven")


def ordered_runs(lines: DataFrame, keys: list[str], order: str, key: str, label: str) -> DataFrame:
    """(keys, total, parts): each `Total ...` line of an ordered list and what it sums: the lines since the total before it, or with fewer than two the totals before it."""
    is_total = F.lower(F.trim(label)).rlike(r"^total\b")
    w = Window.partitionBy(*keys).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.withColumn("_total", is_total).withColumn("_block", F.coalesce(F.count_if("_total").over(before), F.lit(0)))
    since = F.collect_list(F.when(~F.col("_total"), F.struct("_block", F.col(key).alias("k")))).over(before)
    totals = F.collect_list(F.when(F.col("_total"), F.col(key))).over(before)
    rows = rows.withColumn("_since", since).withColumn("_totals", totals).where("_total")
    own = F.transform(F.filter("_since", lambda x: x["_block"] == F.col("_block")), lambda x: x["k"])
    parts = F.when(F.size(own) >= 2, own).when(F.size("_totals") >= 2, F.col("_totals"))
    return rows.select(*keys, F.col(key).alias("total"), parts.alias("parts")).where("parts IS NOT NULL")


def learned_totals(runs: DataFrame, figures: DataFrame, keys: list[str], period: str, key: str, value: str, least: int = 4) -> DataFrame:
    """(keys, total, parts, period, holds): runs that add up in more periods than not, `least` at least, and each period's verdict.

    A run adds up within half a printed step for each part (the coarsest power of ten that all figures are multiples of),
    or 0.2% of the total. Periods that lack one of its figures say nothing.
    """
    from ..functions.rounding import coarsest_step

    each = runs.select(*keys, "total", "parts", F.explode(F.concat("parts", F.array("total"))).alias(key))
    met = each.join(figures.select(*keys, period, key, value), [*keys, key])
    agg = met.groupBy(*keys, "total", "parts", period).agg(F.collect_list(value).alias("_all"), F.sum(F.when(F.col(key) != F.col("total"), F.col(value))).alias("_sum"), F.max(F.when(F.col(key) == F.col("total"), F.col(value))).alias("_t"))
    agg = agg.where(F.size("_all") == F.size("parts") + 1)
    slack = F.greatest(F.abs("_t") * 0.002, coarsest_step(F.col("_all")) * F.size("parts") / 2)
    judged = agg.withColumn("holds", F.abs(F.col("_sum") - F.col("_t")) <= slack)
    w = Window.partitionBy(*keys, "total", "parts")
    good, bad = F.count_if("holds").over(w), F.count_if(~F.col("holds")).over(w)
    return judged.withColumn("_g", good).withColumn("_b", bad).where((F.col("_g") >= least) & (F.col("_g") > F.col("_b"))).select(*keys, "total", "parts", period, "holds")


def states_one_period(row_numbers: Column, quote: Column, years: Column) -> Column:
    """Whether a figure's source states its own period only: a row of one figure, or a quote that names no earlier period and no other year.

    years: an array of the years that are the figure's own.
    """
    # Fixed value: words that name an earlier period.
    earlier = r"(?i)\b(?:a year (?:ago|earlier)|year[- ]ago|prior[- ](?:year|quarter|period)|previous (?:year|quarter)|last (?:year|quarter)|same (?:period|quarter) (?:of|last)|compared (?:to|with)|versus|vs\.?|(?:up|down) from|from \$)"
    named = F.transform(F.regexp_extract_all(quote, F.lit(r"(?<![0-9.,$])((?:19|20)[0-9]{2})(?![0-9.,])"), F.lit(1)), lambda y: y.cast("int"))
    numbers = F.filter(F.coalesce(row_numbers, F.array().cast("array<double>")), lambda n: n.isNotNull())
    by_quote = F.coalesce((quote != "") & ~quote.rlike(earlier) & (F.size(F.array_except(named, years)) == 0), F.lit(False))
    return F.when(F.size(numbers) > 0, F.size(numbers) == 1).otherwise(by_quote)


def row_shows(row_numbers: Column, value: Column, other: Column) -> Column:
    """Whether the printed row of a figure (its own number first) gives another figure too, so that a repeat is the company's own."""
    scale = value / F.nullif(F.get(row_numbers, 0), F.lit(0.0))
    rest = F.slice(row_numbers, F.lit(2), F.greatest(F.size(row_numbers) - 1, F.lit(0)))
    return F.coalesce(F.exists(rest, lambda n: F.abs(n * scale - other) <= F.abs(other) * 1e-6), F.lit(False))


def unread_lines(listed: DataFrame, read: DataFrame, keys: list[str]) -> DataFrame:
    """Listed lines that no reading has."""
    return listed.join(read.select(*keys).distinct(), keys, "left_anti")


def audited(df: DataFrame, keys: list[str], checks: list[Check]) -> DataFrame:
    """(check, findings): what every check would say of all rows, whatever kinds and methods it was made for."""
    wide = [Check(c.name, c.bad) for c in checks]
    return findings(df, keys, wide).groupBy("check").agg(F.count("*").cast("long").alias("findings"))


def printed_totals(lines: DataFrame, keys: list[str], order: str, label: str, value: str, tolerance: Column | float = 0.5) -> DataFrame:
    """(keys, total, result): each printed `Total ...` against the lines above it.

    The lines since the total or heading before it, or those and the totals before it; half a unit for each term. A total
    with fewer than two lines above gives none.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    is_total = F.lower(F.trim(label)).rlike(r"^total\b")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ends = is_total | F.col(value).isNull()
    rows = lines.withColumn("_t", is_total & F.col(value).isNotNull()).withColumn("_block", F.coalesce(F.count_if(ends).over(before), F.lit(0)))
    own = F.sum(F.when(~F.col("_t"), F.col(value))).over(Window.partitionBy(*keys, "_block"))
    n = F.count_if(~F.col("_t") & F.col(value).isNotNull()).over(Window.partitionBy(*keys, "_block"))
    rows = rows.withColumn("_own", F.coalesce(own, F.lit(0.0))).withColumn("_n", n)
    totals, many = F.sum(F.when(F.col("_t"), F.col(value))).over(before), F.coalesce(F.count_if("_t").over(before), F.lit(0))
    rows = rows.withColumn("_before", totals).withColumn("_many", many).where("_t")
    near = lambda x, terms: F.abs(x - F.col(value)) <= tolerance * (terms + 1)
    holds = ((F.col("_n") >= 2) & near(F.col("_own"), F.col("_n"))) | ((F.col("_many") >= 1) & near(F.col("_own") + F.col("_before"), F.col("_n") + F.col("_many")))
    judged = (F.col("_n") >= 2) | ((F.col("_many") >= 1) & (F.col("_n") + F.col("_many") >= 2))
    return rows.select(*keys, F.col(label).alias("total"), outcome(judged & ~F.coalesce(holds, F.lit(False)), judged & holds).alias("result"))


SECTION = r"(?i)\b(operat|invest|financ)\w*\s+activities\b"


def section_totals(lines: DataFrame, keys: list[str], order: str, label: str, value: str, tolerance: float = 0.5) -> DataFrame:
    """(keys, section, result): a cash flow's operating, investing and financing totals against the lines above them, back to the section before.

    Headings (no value) and lines of fewer than two above a total give none; half a unit for each term.
    """
    total = F.col(value).isNotNull() & F.col(label).rlike(r"(?i)^(?:net\s+)?cash\b.*" + SECTION[4:]) & ~F.col(label).rlike(r"(?i)\bother\b")
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.withColumn("_t", total).withColumn("_block", F.coalesce(F.count_if("_t").over(before), F.lit(0)))
    agg = rows.groupBy(*keys, "_block").agg(
        F.sum(F.when(~F.col("_t"), F.col(value))).alias("_sum"), F.count_if(~F.col("_t") & F.col(value).isNotNull()).alias("_n"), F.max(F.when(F.col("_t"), F.col(value))).alias("_total"),
        F.max(F.when(F.col("_t"), F.concat(F.lower(F.regexp_extract(label, SECTION, 1)), F.lit("ing")))).alias("section"),
    )
    gap, terms = F.abs(F.col("_sum") - F.col("_total")), F.col("_n") + 1
    judged = F.col("_n") >= 2
    return agg.where("section IS NOT NULL").select(*keys, "section", outcome(judged & (gap > tolerance * terms), judged & (gap <= tolerance * terms)).alias("result"))


def tagged_identities(facts: DataFrame, keys: list[str], tag: str, value: str, unit: str) -> DataFrame:
    """(keys, check, result) of tagged totals: assets against claims and against their current and other parts, profit against its owners' parts, the change in cash against its balances or its sections.

    Within half a unit for each term; what lacks a tag gives none.
    """
    names = "Assets EquityAndLiabilities Liabilities Equity CurrentAssets NoncurrentAssets ProfitLoss ProfitLossAttributableToOwnersOfParent ProfitLossAttributableToNoncontrollingInterests IncreaseDecreaseInCashAndCashEquivalents EffectOfExchangeRateChangesOnCashAndCashEquivalents CashAndCashEquivalentsAtBeginningOfPeriod CashAndCashEquivalentsAtEndOfPeriod CashFlowsFromUsedInOperatingActivities CashFlowsFromUsedInInvestingActivities CashFlowsFromUsedInFinancingActivities".split()
    wide = facts.groupBy(*keys).agg(F.max(unit).alias("_u"), *[F.max(F.when(F.col(tag) == n, F.col(value))).alias(n) for n in names])
    col = {n: F.col(n) for n in names}
    near = lambda a, b, terms: F.abs(a - b) <= 0.5 * terms * F.col("_u")
    right = F.coalesce(col["EquityAndLiabilities"], col["Liabilities"] + col["Equity"])
    parts = col["CurrentAssets"] + col["NoncurrentAssets"]
    balance = near(col["Assets"], right, 2) & F.coalesce(near(col["Assets"], parts, 2), F.lit(True))
    owners = near(col["ProfitLoss"], col["ProfitLossAttributableToOwnersOfParent"] + col["ProfitLossAttributableToNoncontrollingInterests"], 2)
    change = col["IncreaseDecreaseInCashAndCashEquivalents"]
    moved = near(change, col["CashAndCashEquivalentsAtEndOfPeriod"] - col["CashAndCashEquivalentsAtBeginningOfPeriod"], 2)
    flows = near(change, sum(col[f"CashFlowsFromUsedIn{s}Activities"] for s in ("Operating", "Investing", "Financing")) + F.coalesce(col["EffectOfExchangeRateChangesOnCashAndCashEquivalents"], F.lit(0.0)), 4)
    each = [F.struct(F.lit(n).alias("check"), outcome(~ok, ok).alias("result")) for n, ok in (("balance", balance), ("profit", owners), ("cash", F.coalesce(moved, flows)))]
    return wide.select(*keys, F.explode(F.array(*each)).alias("c")).select(*keys, "c.*")


def cash_by_balances(flows: DataFrame, balances: DataFrame, keys: list[str], slack: int = 7) -> DataFrame:
    """(keys, id, proved): cash flows whose change in cash is what the balances at both ends of the period give.

    flows: keys, id, accession, start, end, change; balances: keys, accession, day, cash, filed. Of balances near a day
    the same filing's goes first, then the newest; within two units of the coarsest figure.
    """
    from ..functions.rounding import rounding_unit
    from .joins import within_days

    b = balances.select(*keys, F.col("accession").alias("_a"), F.col("day").alias("_day"), F.col("cash").alias("_cash"), F.col("filed").alias("_filed"))
    asks = flows.select(*keys, "id", "accession", "change", F.explode(F.array(F.struct(F.lit("open").alias("side"), F.date_sub("start", 1).alias("at")), F.struct(F.lit("close").alias("side"), F.col("end").alias("at")))).alias("x")).select("*", "x.side", "x.at").drop("x")
    near = within_days(asks, b, keys, "at", "_day", slack)
    best = near.groupBy(*keys, "id", "change", "side").agg(F.max_by("_cash", F.struct((F.col("_a") == F.col("accession")).alias("own"), "_filed", "_day", "_cash")).alias("cash"))
    wide = best.groupBy(*keys, "id", "change").agg(F.max(F.when(F.col("side") == "open", F.col("cash"))).alias("_o"), F.max(F.when(F.col("side") == "close", F.col("cash"))).alias("_c"))
    unit = F.least(F.greatest(*[rounding_unit(F.col(c)) for c in ("change", "_o", "_c")]), F.lit(1e6))
    moved = F.col("_c") - F.col("_o")
    return wide.where("_o IS NOT NULL AND _c IS NOT NULL").select(*keys, "id", (F.abs(moved - F.col("change")) <= 2 * unit).alias("proved"))


def second_opinion(lines: DataFrame, facts: DataFrame, keys: list[str], concept: str, value: str) -> DataFrame:
    """(keys, matched, missing, differing, result): a reading's lines against another processor's facts, signs aside.

    A line matches if any fact of its concept has its value; fail if one differs, pass if one matches, else none.
    """
    f = facts.groupBy(*keys, concept).agg(F.collect_set(value).alias("_all"))
    both = lines.where(F.col(value).isNotNull()).join(f, [*keys, concept], "left")
    same = F.exists("_all", lambda v: F.abs(F.abs(v) - F.abs(F.col(value))) <= 1e-6 * F.greatest(F.lit(1.0), F.abs(v), F.abs(F.col(value))))
    n = lambda c: F.count_if(c).cast("long")
    agg = both.groupBy(*keys).agg(n(same).alias("matched"), n(F.col("_all").isNull()).alias("missing"), n(~same).alias("differing"))
    return agg.withColumn("result", outcome(F.col("differing") > 0, F.col("matched") > 0))


def completed_sums(lines: DataFrame, arcs: DataFrame, keys: list[str], tolerance: float = 0.5) -> DataFrame:
    """(keys, parent, result): a declared sum against the printed lines, with lines that the declaration leaves out where only these complete it.

    lines: keys, concept, position, place, value; arcs: parent, child. Left-out lines share the children's place and their
    side of the parent, and no counted line already sums them. declared: the children alone give the parent; completed:
    with the left-out ones; else fail.
    """
    parent = lines.select(*keys, F.col("concept").alias("parent"), F.col("position").alias("_pp"), F.col("value").alias("_total"))
    child = lines.select(*keys, F.col("concept").alias("child"), F.col("position").alias("_cp"), F.col("place").alias("_place"), F.col("value").alias("_child"))
    own = parent.join(arcs, "parent").join(child, [*keys, "child"])
    sums = own.groupBy(*keys, "parent", "_pp", "_total").agg(F.sum("_child").alias("_sum"), F.count("*").alias("_n"), F.max("_cp").alias("_last"), F.collect_set("_place").alias("_places"), F.collect_set("child").alias("_children"))
    grand = arcs.select(F.col("parent").alias("child"), F.col("child").alias("_grand"))
    other = sums.join(lines.select(*keys, "concept", "position", "place", "value"), keys).where(
        (F.col("concept") != F.col("parent")) & ~F.array_contains("_children", F.col("concept")) & F.array_contains("_places", F.col("place"))
        & F.when(F.col("_pp") > F.col("_last"), F.col("position") < F.col("_pp")).otherwise(F.col("position") > F.col("_pp"))
    )
    summed = own.select(*keys, "parent", "child").join(grand, "child").select(*keys, "parent", F.col("_grand").alias("concept"))
    extra = other.join(summed, [*keys, "parent", "concept"], "left_anti").groupBy(*keys, "parent").agg(F.sum("value").alias("_extra"), F.count("*").alias("_m"))
    both = sums.join(extra, [*keys, "parent"], "left")
    fits = lambda x, n: F.abs(x - F.col("_total")) <= tolerance * (n + 1)
    result = F.when(fits(F.col("_sum"), F.col("_n")), "declared").when(fits(F.col("_sum") + F.col("_extra"), F.col("_n") + F.col("_m")), "completed").otherwise("fail")
    return both.select(*keys, "parent", result.alias("result"))
