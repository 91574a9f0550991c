"""Flagged figures settled by evidence: reported totals, the next year's release, last year's figure, the filing itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import words
from ..functions.numbers import parse_number
from ..functions.rounding import release_unit, stated_tolerance
from .joins import cut, newest_per_key, within_days

# Days within which a period is another one's, shares within which figures are equal, the largest restatement.
DAYS, EQUAL, TOTAL, MOST_RESTATED = 12, 1e-4, 0.001, 0.5


def equals_named_line(flagged: DataFrame, reported: DataFrame, keys: list[str], day: str, value: str, label: str, tolerance: float = EQUAL) -> DataFrame:
    """Flagged rows that equal a reported line of their period, within a share of it, whose label shares a word of four letters."""
    r = reported.select(*keys, F.col(day).alias("_day"), F.col(value).alias("_v"), F.col(label).alias("_l"))
    long = lambda c: F.filter(words(c), lambda w: F.length(w) >= 4)
    near = within_days(flagged, r, keys, day, "_day", DAYS).where(F.abs(F.col(value) - F.col("_v")) <= tolerance * F.abs("_v"))
    return near.where(F.arrays_overlap(long(F.col(label)), long(F.col("_l")))).select(*flagged.columns).distinct()


def adds_to_reported(parts: DataFrame, reported: DataFrame, keys: list[str], group: list[str], day: str, value: str, half: str) -> DataFrame:
    """(group): breakdowns whose parts add up to a reported figure of their period, within half of the last printed place of each part."""
    sums = parts.groupBy(*keys, *group, day).agg(F.sum(value).alias("_sum"), F.sum(half).alias("_slack"))
    near = within_days(sums, reported.select(*keys, F.col(day).alias("_day"), F.col(value).alias("_v")), keys, day, "_day", DAYS)
    return near.where(F.abs(F.col("_sum") - F.col("_v")) <= F.greatest("_slack", F.lit(0.5))).select(*keys, *group).distinct()


def later_release(flagged: DataFrame, releases: DataFrame, keys: list[str], day: str, value: str, tolerance: float = EQUAL, most: float = MOST_RESTATED) -> DataFrame:
    """(flagged columns, outcome, restated): what the year-ago column of a release a year later says of flagged figures.

    confirmed: one of its figures is equal; restated: it gives exactly one other figure, no further off than `most`; held:
    several, or one further off. Rows without such a release aren't listed.
    """
    r = releases.select(*keys, F.col(day).alias("_day"), F.col(value).alias("_v"))
    near = within_days(flagged, r, keys, day, "_day", DAYS, 365)
    agg = near.groupBy(*flagged.columns).agg(F.collect_set("_v").alias("_all"))
    same = F.exists("_all", lambda v: F.abs(v - F.col(value)) <= tolerance * F.abs(F.col(value)))
    only = F.when(F.size("_all") == 1, F.get("_all", 0))
    restated = F.when(~same & (F.abs(only - F.col(value)) <= most * F.abs(F.col(value))), only)
    return agg.withColumn("outcome", F.when(same, "confirmed").when(restated.isNotNull(), "restated").otherwise("held")).withColumn("restated", restated).drop("_all")


def unanchored(breakdowns: DataFrame, reported: DataFrame, keys: list[str], day: str, total: str, value: str, tolerance: float = TOTAL) -> DataFrame:
    """Breakdowns whose total matches no figure reported for their period, where any is."""
    near = within_days(breakdowns, reported.select(*keys, F.col(day).alias("_day"), F.col(value).alias("_v")), keys, day, "_day", DAYS)
    agg = near.groupBy(*breakdowns.columns).agg(F.bool_or(F.abs(F.col("_v") - F.col(total)) <= tolerance * F.abs(F.col(total))).alias("_ok"))
    return agg.where("NOT _ok").drop("_ok")


def tied_rows(rows: DataFrame, keys: list[str], day: str, value: str, filing: str, numbers: str, tolerance: float = EQUAL) -> DataFrame:
    """(rows): held rows whose own printed row gives last year's accepted figure, read from another filing.

    rows: keys (a series), day, value, filing, numbers (the row's numbers as printed, the read one first), status. Oldest
    first: a row cleared so is last year's figure for the next; each round clears one more year, until none is cleared.
    """
    held = cut(rows.where("status = 'held'"))
    accepted = cut(rows.where("status = 'accepted'").select(*keys, F.col(day).alias("_day"), F.col(value).alias("_v"), F.col(filing).alias("_f")))
    out = None
    while True:
        near = within_days(held, accepted, keys, day, "_day", DAYS, -365).where(F.col("_f") != F.col(filing))
        unit = release_unit(F.col(value), F.get(numbers, 0))
        ties = F.exists(F.slice(numbers, F.lit(2), F.greatest(F.size(numbers) - 1, F.lit(0))), lambda n: F.abs(n * unit - F.col("_v")) <= tolerance * F.abs("_v"))
        found = cut(near.where(ties).select(*rows.columns).distinct())
        if found.isEmpty():
            return held.limit(0) if out is None else out
        out = found if out is None else out.union(found)
        accepted = accepted.union(found.select(*keys, F.col(day).alias("_day"), F.col(value).alias("_v"), F.col(filing).alias("_f")))
        held = cut(held.join(found.select(*keys, day), [*keys, day], "left_anti"))


def stale_holds(rows: DataFrame, group: list[str], note: str, still: Column) -> DataFrame:
    """Rows whose hold no longer holds anywhere in their group: `still` says for each row whether its note's reason is there."""
    return rows.withColumn("_still", F.bool_or(still).over(Window.partitionBy(*group))).where(F.col(note).isNotNull() & ~F.col("_still")).drop("_still")


def stated_in_filing(quote: Column, value_text: Column, value: Column, unit: Column, factor: Column) -> Column:
    """Whether a quote states the very figure: its text, by its own scale word, or by a scale that the filing gives (factor, else null).

    A fall that the quote names turns the sign. An amount of 100,000 or more has to have a scale.
    """
    from ..functions.labels import falls

    n = parse_number(value_text)
    near = lambda a, b: F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.abs(b))
    equal = lambda x: near(x, value) | ((value < 0) & (x > 0) & near(x, -value) & falls(quote, value_text))
    alone = equal(n["value"]) & (n["scale_word"].isNotNull() | n["percent"] | (unit != "currency") | (F.abs(value) < 1e5))
    scaled = n["scale_word"].isNull() & factor.isNotNull() & equal(n["value"] * factor)
    return F.coalesce(quote.contains(value_text) & (value_text != "") & (alone | F.coalesce(scaled, F.lit(False))), F.lit(False))


def filled_by_tag(readings: DataFrame, facts: DataFrame, tags: DataFrame, keys: list[str], item: str, tag: str, value: str) -> DataFrame:
    """(keys, item, value): periods without a reading, from the tag that was learned for the item; items of several tags get none."""
    one = tags.withColumn("_n", F.count("*").over(Window.partitionBy(item))).where("_n = 1").select(item, tag)
    found = facts.join(one, tag).select(*keys, item, value)
    return found.join(readings.select(*keys, item), [*keys, item], "left_anti")


def exact_values(rounded: DataFrame, facts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(rounded columns, exact): the one tagged figure that is a stated one to more places, within half a unit of its rounding."""
    f = facts.select(*keys, F.col(value).alias("exact"))
    near = rounded.join(f, keys).where((F.col("exact") != F.col(value)) & (F.abs(F.col("exact") - F.col(value)) <= stated_tolerance(F.col(value))))
    return near.withColumn("_n", F.count("*").over(Window.partitionBy(*rounded.columns))).where("_n = 1").drop("_n")


def reread_disagreements(before: DataFrame, after: DataFrame, keys: list[str], value: str, tolerance: float = 0.005) -> DataFrame:
    """(keys, before, after): figures that two readings of one filing give apart by more than a share of the larger."""
    both = before.select(*keys, F.col(value).alias("before")).join(after.select(*keys, F.col(value).alias("after")), keys)
    return both.where(F.abs(F.col("before") - F.col("after")) > tolerance * F.greatest(F.abs("before"), F.abs("after")))


def learned_tags(readings: DataFrame, facts: DataFrame, keys: list[str], item: str, tag: str, value: str, least: int = 2) -> DataFrame:
    """(item, tag): tags whose facts are evidence of an item's readings, `least` different ones, and contradict none of them."""
    from ..functions.rounding import is_evidence

    both = readings.select(*keys, item, F.col(value).alias("_v")).join(facts.select(*keys, tag, F.col(value).alias("_f")), keys)
    agrees = F.abs(F.col("_f") - F.col("_v")) <= stated_tolerance(F.col("_v"))
    agg = both.groupBy(item, tag).agg(F.count_distinct(F.when((F.col("_f") != 0) & is_evidence(F.col("_f"), F.col("_v")), F.round("_v", 9))).alias("_n"), F.bool_and(agrees).alias("_all"))
    return agg.where(F.col("_all") & (F.col("_n") >= least)).select(item, tag)


def settled(agreed: DataFrame, disputed: DataFrame, totals: DataFrame, keys: list[str], item: str, value: str, total: str, tolerance: float = TOTAL) -> DataFrame:
    """(keys, item, value): of the disputed readings (item, reader, value) the reader's whose figures, with those agreed, add up to the total.

    Both readers' or neither's: nothing is settled.
    """
    base = agreed.groupBy(*keys).agg(F.sum(value).alias("_base"))
    sums = disputed.groupBy(*keys, "reader").agg(F.sum(value).alias("_own")).join(base, keys, "left").join(totals.select(*keys, F.col(total).alias("_t")), keys)
    fits = sums.where(F.abs(F.coalesce("_base", F.lit(0.0)) + F.col("_own") - F.col("_t")) <= tolerance * F.abs("_t"))
    one = fits.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where("_n = 1").select(*keys, "reader")
    return disputed.join(one, [*keys, "reader"]).select(*keys, item, value)


def newest_evidence(evidence: DataFrame, rule: str, day: str, live_after: int = 3) -> DataFrame:
    """(rule, state): a learned rule is live after so many agreements in a row, demoted by a disagreement since, else in shadow."""
    w = Window.partitionBy(rule).orderBy(F.desc(day))
    missed = F.max(F.when(~F.col("agreed"), F.col(day))).over(Window.partitionBy(rule))
    rows = evidence.withColumn("_missed", missed).withColumn("_n", F.row_number().over(w))
    agg = rows.groupBy(rule).agg(
        F.count_if(F.col("agreed") & (F.col("_missed").isNull() | (F.col(day) > F.col("_missed")))).alias("_run"), F.count_if("agreed").alias("_ok"), F.bool_or(~F.col("agreed")).alias("_bad"),
    )
    return agg.select(rule, F.when(F.col("_run") >= live_after, "live").when(F.col("_bad") & (F.col("_ok") >= live_after), "demoted").otherwise("shadow").alias("state"))


def choose_evidence(evidence: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, kind): of all evidence for a figure the kind that comes first in the order given."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("kind"))
    return newest_per_key(evidence.withColumn("_rank", rank).where("_rank > 0").select(*keys, "kind", "_rank").distinct(), keys, [F.col("_rank")]).select(*keys, "kind")
