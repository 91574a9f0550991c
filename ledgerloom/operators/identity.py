"""Which lines of different presentations are one series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import cut, newest_per_key, only_pairs, within_days


def series(edges: DataFrame) -> DataFrame:
    """(node, series): the lowest node that edges (a, b) lead to.

    Labels travel along edges and then along themselves, so the number of rounds grows with the logarithm of a
    component's width. Each round reads the last one's checkpoint.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct())
    now = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("series")))
    while True:
        near = both.join(now.select(F.col("node").alias("b"), "series"), "b").groupBy(F.col("a").alias("node")).agg(F.min("series").alias("m"))
        step = now.join(near, "node").select("node", F.least("series", "m").alias("series"))
        jump = step.select(F.col("node").alias("series"), F.col("series").alias("j"))
        new = cut(step.join(jump, "series").select("node", F.least("series", "j").alias("series")))
        if new.join(now, ["node", "series"], "left_anti").isEmpty():
            return new
        now = new


def renamed(later: DataFrame, earlier: DataFrame, keys: list[str], name: str, value: str) -> DataFrame:
    """Pairs of names whose figures are equal under the same keys and which no other name shares."""
    l, e = later.select(*keys, F.col(name).alias("later_name"), value), earlier.select(*keys, F.col(name).alias("earlier_name"), value)  # noqa: E741
    return only_pairs(l.join(e, [*keys, value]).select("later_name", "earlier_name").distinct(), "later_name", "earlier_name")


def kept_group(new: DataFrame, old: DataFrame, group: str, item: str, value: str, least: float = 0.5) -> DataFrame:
    """(new, old) groups of which at least half the items are common and all common ones equal; the best of each new group."""
    a, b = new.select(F.col(group).alias("new_group"), item, F.col(value).alias("_n")), old.select(F.col(group).alias("old_group"), item, F.col(value).alias("_o"))
    sizes = new.groupBy(F.col(group).alias("new_group")).agg(F.count("*").alias("_size"))
    agg = a.join(b, item).groupBy("new_group", "old_group").agg(F.count("*").alias("common"), F.bool_and(F.col("_n") == F.col("_o")).alias("_same"))
    fit = agg.where("_same").join(sizes, "new_group").where(F.col("common") >= least * F.col("_size"))
    return newest_per_key(fit.select("new_group", "old_group", "common"), ["new_group"], [F.desc("common"), F.col("old_group")])


def joined_axes(rows: DataFrame, standard: DataFrame, keys: list[str], group: str, item: str, value: str) -> DataFrame:
    """(group, target): groups of a company's own axis that a standard group continues.

    rows and standard: keys (a period), group, item, value. Half of a group's items, two at least, are the target's, the
    target shares the most, and no period that both hold has other figures.
    """
    own = rows.select(F.col(group).alias("_g"), item).distinct()
    theirs = standard.select(F.col(group).alias("_t"), item).distinct()
    size = own.groupBy("_g").agg(F.count("*").alias("_size"))
    shared = own.join(theirs, item).groupBy("_g", "_t").agg(F.count("*").alias("_n")).join(size, "_g").where("_n >= 2 AND 2 * _n >= _size")
    best = shared.groupBy("_g").agg(F.max_by("_t", F.struct("_n", "_t")).alias("_t"))
    both = standard.select(F.col(group).alias("_t"), *keys).distinct()
    held = rows.select(F.col(group).alias("_g"), *keys, item, value).join(best, "_g").join(both, ["_t", *keys])
    figures = standard.select(F.col(group).alias("_t"), *keys, item, F.col(value).alias("_v"))
    bad = held.join(figures, ["_t", *keys, item], "left").where(F.col("_v").isNull() | (F.abs(F.col("_v") - F.col(value)) > 1e-9 * F.abs(F.col(value)))).select("_g").distinct()
    return best.join(bad, "_g", "left_anti").select(F.col("_g").alias(group), F.col("_t").alias("target"))


def merged_duplicates(rows: DataFrame, keys: list[str], item: str, value: str, later: str) -> DataFrame:
    """(keys, item, target): figures of a period's own report whose number a later report's column (column `later`) gives under another item.

    Only where exactly one figure on each side has the number, and neither item is on both sides.
    """
    own, other = rows.where(~F.col(later)), rows.where(F.col(later))
    alone = own.join(other.select(*keys, item), [*keys, item], "left_anti").select(*keys, item, value).where(F.col(value) != 0)
    theirs = other.join(own.select(*keys, item), [*keys, item], "left_anti").select(*keys, F.col(item).alias("target"), value)
    counted = own.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    pairs = alone.join(theirs, [*keys, value]).join(counted.where("_n = 1").drop("_n"), [*keys, value])
    one = pairs.withColumn("_m", F.count("*").over(Window.partitionBy(*keys, value)))
    return one.where("_m = 1").select(*keys, item, "target")


def year_remainders(rows: DataFrame, keys: list[str], period: str, item: str, named: str) -> DataFrame:
    """(keys, period, item, target): a quarter's item without an element of its own (column `named` false) that its year lists under another name.

    It is in no other period of the year, the quarter has nothing else that the others lack, and exactly one item that
    all other periods list is missing from it.
    """
    each = rows.select(*keys, period, item, named).distinct()
    n_periods = each.groupBy(*keys).agg(F.count_distinct(period).alias("_periods"))
    held = each.groupBy(*keys, item).agg(F.collect_set(period).alias("_in"))
    wide = each.select(*keys, period).distinct().join(held, keys).join(n_periods, keys)
    here = F.array_contains("_in", F.col(period))
    found = wide.groupBy(*keys, period, "_periods").agg(
        F.collect_list(F.when(here & (F.size("_in") == 1), F.col(item))).alias("_only"), F.collect_list(F.when(~here & (F.size("_in") == F.col("_periods") - 1), F.col(item))).alias("_missing"),
    )
    found = found.where((F.size("_only") == 1) & (F.size("_missing") == 1) & (F.col("_periods") > 1) & (F.col(period) != "FY"))
    out = found.select(*keys, period, F.get("_only", 0).alias(item), F.get("_missing", 0).alias("target"))
    return out.join(each.where(~F.col(named)).select(*keys, period, item), [*keys, period, item], "left_semi")


def continued_lines(openings: DataFrame, series: DataFrame, keys: list[str], item: str, end: str, value: str, days: int = 12, tolerance: float = 1e-4) -> DataFrame:
    """(keys, item, predecessor): a line that starts later than its group, and the one ended line it continues.

    openings: keys, item, end and `cells`, the year-ago cells of the row of its first reading. series: keys, item, end,
    value of all readings. The predecessor's figure a year before the opening is one of the cells; lines that ever share a
    period are two.
    """
    span = series.groupBy(*keys, item).agg(F.max(end).alias("_last"))
    newest = span.groupBy(*keys).agg(F.max("_last").alias("_newest"))
    ended = span.join(newest, keys).where("_last < _newest").select(*keys, item)
    before = series.join(ended, [*keys, item], "left_semi").select(*keys, F.col(item).alias("predecessor"), F.col(end).alias("_end"), F.col(value).alias("_value"))
    near = within_days(openings, before, keys, end, "_end", days, -365)
    pairs = near.where(F.exists("cells", lambda c: F.abs(c - F.col("_value")) <= tolerance * F.abs("_value"))).select(*keys, item, "predecessor").distinct()
    one = pairs.withColumn("_n", F.count("*").over(Window.partitionBy(*keys, item))).where("_n = 1").drop("_n")
    mine = series.select(*keys, item, end)
    together = one.join(mine, [*keys, item]).join(series.select(*keys, F.col(item).alias("predecessor"), end), [*keys, "predecessor", end])
    return one.join(together.select(*keys, item), [*keys, item], "left_anti")


def relabelled(quarters: DataFrame, comparatives: DataFrame, annual: DataFrame, keys: list[str], period: str, item: str, value: str) -> DataFrame:
    """(keys, item, true_item): the one renaming of a year's items that later comparatives and the year itself allow.

    Only years whose quarters list the same items, and of which a comparative contradicts one: the same item restated with
    another item's figure. An item may have another's name if that name's comparatives are its figures and its fourth quarter
    isn't below zero; a renaming is a matching of items and names. Years with none or several give nothing. Any number of items.
    """
    types = ", ".join(f"`{k}` {quarters.schema[k].dataType.simpleString()}" for k in keys)
    row = lambda df, name: F.struct(F.lit(name).alias("side"), (F.col(period) if period in df.columns else F.lit("FY")).alias("p"), F.col(item).alias("i"), F.col(value).cast("double").alias("v"))
    sides = [df.select(*keys, row(df, name).alias("r")) for df, name in ((quarters, "q"), (comparatives, "c"), (annual, "y"))]
    gathered = sides[0].union(sides[1]).union(sides[2]).groupBy(*keys).agg(F.collect_list("r").alias("_r"))

    def fit(batches):
        from ledgerloom.operators.identity import _renaming

        for batch in batches:
            found = [[*key, *pair] for *key, rows in zip(*(batch[c] for c in [*keys, "_r"])) for pair in _renaming(rows)]
            yield pd.DataFrame(found, columns=[*keys, item, "true_item"])

    kind = quarters.schema[item].dataType.simpleString()
    return gathered.mapInPandas(fit, f"{types}, `{item}` {kind}, true_item {kind}")


def _renaming(rows: list[dict]) -> list[tuple]:
    """Pairs of a stored item and its true one in a year's rows (side, p, i, v), none if there is none or several."""
    from .sums import only_matching

    own: dict[str, dict] = {"q": {}, "c": {}, "y": {}}
    for r in rows:
        own[r["side"]].setdefault(r["p"], {})[r["i"]] = r["v"]
    quarters = own["q"]
    names = sorted(next(iter(quarters.values()), {}))
    if len(names) < 2 or any(sorted(q) != names for q in quarters.values()):
        return []
    place = {x: k for k, x in enumerate(names)}
    # may[a, b]: the figures stored as names[a] may be those of names[b]
    may, contradicted = np.ones((len(names), len(names)), dtype=bool), False
    for p in own["c"].keys() & quarters.keys():
        figures = np.array([quarters[p][x] for x in names], dtype=float)
        for i, v in own["c"][p].items():
            if i in place:
                equal = np.abs(figures - v) <= 1e-9 * np.maximum(np.maximum(np.abs(figures), abs(v)), 1.0)
                contradicted |= bool(not equal[place[i]] and equal.any())
                may[:, place[i]] &= equal
    year = own["y"].get("FY", {})
    if sorted(year) == names:
        spent = np.array([sum(q[x] for q in quarters.values()) for x in names])
        may &= np.array([year[x] for x in names])[None, :] >= spent[:, None]
    found = only_matching([np.flatnonzero(x).tolist() for x in may]) if contradicted else None
    return [] if found is None else [(a, names[b]) for a, b in zip(names, found)]


def outside_eras(lines: DataFrame, segments: DataFrame, keys: list[str], group: str, item: str, order: str) -> DataFrame:
    """(keys, group, item, order): lines named for a segment in a period that is tagged, before the segment's first one or after its last.

    lines: keys, group, item, segment (the one it names, or null), order; segments: keys, segment, order. Only groups of
    which two lines or more name a segment.
    """
    spans = segments.groupBy(*keys, "segment").agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    tagged = segments.select(*keys, order).distinct()
    of_segments = lines.where("segment IS NOT NULL").groupBy(*keys, group).agg(F.count_distinct(item).alias("_n")).where("_n >= 2").select(*keys, group)
    named = lines.where("segment IS NOT NULL").join(of_segments, [*keys, group], "left_semi").join(tagged, [*keys, order], "left_semi").join(spans, [*keys, "segment"])
    return named.where((F.col(order) < F.col("_first")) | (F.col(order) > F.col("_last"))).select(*keys, group, item, order)


def misfiled_years(rows: DataFrame, annual: DataFrame, keys: list[str], day: str, total: str, days: int = 12, tolerance: float = 0.01) -> DataFrame:
    """Rows stored as fourth quarters whose total is that of a year that ends with them: they are the year's."""
    a = annual.select(*keys, F.col(day).alias("_day"), F.col(total).alias("_total"))
    near = within_days(rows.where(F.col(total).isNotNull()), a, keys, day, "_day", days)
    return near.where(F.abs(F.col(total) - F.col("_total")) <= tolerance * F.abs("_total")).select(*rows.columns).distinct()


def newest_labels(rows: DataFrame, keys: list[str], label: str, day: str) -> DataFrame:
    """(keys, label): each series' latest label; of one day the last by name."""
    return rows.groupBy(*keys).agg(F.max_by(label, F.struct(day, label)).alias(label))


def line_keys(votes: DataFrame, apart: DataFrame, likes: DataFrame) -> DataFrame:
    """(node, key): lines that are one series, by votes of equal figures; key is the lowest node of a series.

    votes: (a, b) with `votes`; apart: pairs that are printed side by side somewhere, which never become one; likes: pairs
    whose labels share a word. A pair is joined with two votes or more, or with one and a word. Rounds: each group joins
    the one that most votes name, unless members of the two are apart; ties go to the lower one, and only mutual choices
    are joined, so the result doesn't depend on the order of rows.
    """
    both = lambda df: df.select("a", "b").union(df.select("b", "a")).distinct()
    ok = votes.join(likes.select("a", "b").withColumn("_w", F.lit(True)), ["a", "b"], "left").where("votes >= 2 OR _w").select("a", "b", "votes")
    ok = cut(ok.union(ok.select("b", "a", "votes")))
    never = cut(both(apart))
    group = cut(votes.select(F.col("a").alias("node")).union(votes.select("b")).distinct().withColumn("key", F.col("node")))
    while True:
        left = group.select(F.col("node").alias("a"), F.col("key").alias("ka"))
        right = group.select(F.col("node").alias("b"), F.col("key").alias("kb"))
        of_groups = lambda df: df.join(left, "a").join(right, "b").where("ka <> kb")
        parted = of_groups(never).select("ka", "kb").distinct()
        open_ = of_groups(ok).groupBy("ka", "kb").agg(F.sum("votes").alias("v")).join(parted, ["ka", "kb"], "left_anti")
        best = newest_per_key(open_, ["ka"], [F.desc("v"), F.col("kb")])
        mutual = best.join(best.select(F.col("ka").alias("kb"), F.col("kb").alias("ka")), ["ka", "kb"]).where("kb < ka").select("ka", "kb")
        mutual = cut(mutual)
        if mutual.isEmpty():
            # no two choose each other only if nothing is open
            return group
        group = cut(group.join(mutual, F.col("key") == F.col("ka"), "left").select("node", F.coalesce("kb", "key").alias("key")))
