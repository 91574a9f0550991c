"""Lists of what a company reports: which items hold at a period, what a change adds and retires, how two lists compare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import newest_per_key

# Days of grace around an item's window, days of a quarter and slack when quarters are counted back.
GRACE, QUARTER, SLACK = 10, 91, 20


def reported_at(day: Column, since: Column, until: Column, grace: int = GRACE) -> Column:
    """Whether an item is reported for a period's end; an open side has no limit."""
    return F.coalesce(day >= F.date_sub(since, grace), F.lit(True)) & F.coalesce(day <= F.date_add(until, grace), F.lit(True))


def for_period(items: DataFrame, group: list[str], day: Column, total: str) -> DataFrame:
    """The list at one period: items outside their window left out; a group's total is null if its item is."""
    kept = items.where(reported_at(day, F.col("since"), F.col("until")))
    has = F.bool_or(F.col("key") == F.col(total)).over(Window.partitionBy(*group))
    return kept.withColumn(total, F.when(has, F.col(total)))


def outside_windows(values: DataFrame, windows: DataFrame, keys: list[str], day: str, status: str) -> DataFrame:
    """Values that aren't rejected whose period lies outside their item's window; items without a window have none."""
    both = values.join(windows.select(*keys, "since", "until"), keys)
    return both.where((F.col(status) != "rejected") & ~reported_at(F.col(day), F.col("since"), F.col("until"))).select(*values.columns)


def left_out(before: DataFrame, after: DataFrame, keys: list[str], reason: str) -> DataFrame:
    """Lines of a list that its successor doesn't have, with the reason."""
    return before.join(after.select(*keys), keys, "left_anti").withColumn("reason", F.lit(reason))


def merged_left_out(new: DataFrame, previous: DataFrame, listed: DataFrame, group: str, label: str) -> DataFrame:
    """Left-out lines: this run's first, then earlier ones, each once, none that the list has now.

    A line with a group is the list's own only in that group; one without, in any. Names are compared by letters and
    digits; within a run the first by group and label stays.
    """
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    both = new.withColumn("_run", F.lit(0)).unionByName(previous.withColumn("_run", F.lit(1)), allowMissingColumns=True).withColumn("_name", plain(F.col(label)))
    names = listed.select(F.col(group).alias("_lg"), plain(F.col(label)).alias("_ln")).distinct()
    own = both.where(F.col(group).isNotNull()).join(names, (F.col(group) == F.col("_lg")) & (F.col("_name") == F.col("_ln")), "left_anti")
    loose = both.where(F.col(group).isNull()).join(names.select("_ln").distinct(), F.col("_name") == F.col("_ln"), "left_anti")
    return newest_per_key(own.union(loose), [group, "_name"], [F.col("_run"), F.col(label)]).drop("_run", "_name")


def limited(additions: DataFrame, keys: list[str], existing: str, order: list[Column], most: int) -> DataFrame:
    """The first `most` additions of each list, lines of groups that exist before those of new ones."""
    w = Window.partitionBy(*keys).orderBy(F.col(existing).desc(), *order)
    return additions.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def capped_list(items: DataFrame, keys: list[str], group: str, order: str, kind: str, most: int, least: int) -> DataFrame:
    """A list cut to `most` lines: metric groups lose lines from their end, the first group first, but keep `least`; others are never cut."""
    size = F.count("*").over(Window.partitionBy(*keys))
    back = F.row_number().over(Window.partitionBy(*keys, group).orderBy(F.desc(order)))
    in_group = F.count("*").over(Window.partitionBy(*keys, group))
    first = F.min(order).over(Window.partitionBy(*keys, group))
    rows = items.withColumns({"_over": size - most, "_back": back, "_g": in_group, "_first": first})
    may = (F.col(kind) == "metric") & (F.col("_back") <= F.col("_g") - least)
    cut = F.sum(may.cast("int")).over(Window.partitionBy(*keys).orderBy("_first", "_back"))
    return rows.withColumn("_cut", F.when(may, cut)).where(F.col("_cut").isNull() | (F.col("_cut") > F.col("_over"))).drop("_over", "_back", "_g", "_first", "_cut")


def maintained(items: DataFrame, additions: DataFrame, retired: DataFrame, keys: list[str], group: str, item: str) -> DataFrame:
    """A list with additions to its groups and without what is retired.

    An addition needs its group's unit (any for metrics, percent for a mix, else currency), a group that exists and a free
    key; a retirement never takes a group's last line.
    """
    unit_ok = (F.col("kind") == "metric") | (F.col("unit") == F.when(F.col("kind") == "mix", "percent").otherwise("currency"))
    kinds = items.select(*keys, group, "kind").distinct()
    new = additions.join(kinds, [*keys, group]).where(unit_ok).join(items.select(*keys, group, item), [*keys, group, item], "left_anti")
    grown = items.unionByName(new.dropDuplicates([*keys, group, item]).select(*items.columns))
    gone = grown.join(retired.select(*keys, group, item).withColumn("_gone", F.lit(True)), [*keys, group, item], "left")
    w = Window.partitionBy(*keys, group)
    spared = (F.count_if(F.col("_gone").isNull()).over(w) == 0) & (F.row_number().over(w.orderBy(item)) == 1)
    return gone.withColumn("_spared", spared).where(F.col("_gone").isNull() | F.col("_spared")).drop("_gone", "_spared")


def repeats(groups: DataFrame, tagged: DataFrame, keys: list[str], group: str, item: str) -> DataFrame:
    """(keys, group): groups of two rows or more that name only rows of one tagged breakdown.

    tagged: keys, breakdown, item. Rows of groups that aren't amounts or shares (column `amount` false) don't count.
    """
    own = groups.where("amount").select(*keys, group, item).distinct()
    size = own.groupBy(*keys, group).agg(F.count("*").alias("_size")).where("_size >= 2")
    both = own.join(tagged.select(*keys, "breakdown", item).distinct(), [*keys, item]).groupBy(*keys, group, "breakdown").agg(F.count("*").alias("_n"))
    return both.join(size, [*keys, group]).where("_n = _size").select(*keys, group).distinct()


def long_absent(items: DataFrame, values: DataFrame, keys: list[str], item: str, day: str, quarters: int) -> DataFrame:
    """Items without a figure in their company's newest quarters; one never read counts as absent."""
    newest = values.groupBy(*keys).agg(F.max(day).alias("_newest"))
    recent = values.join(newest, keys).where(F.col(day) >= F.date_sub("_newest", QUARTER * quarters - SLACK)).select(*keys, item).distinct()
    return items.join(recent, [*keys, item], "left_anti")


def list_score(owner: DataFrame, fresh: DataFrame, tagged: DataFrame, keys: list[str], label: str) -> DataFrame:
    """(keys, current, named, from_xbrl, kept, fresh, recall, precision) of a fresh list against an owner's, by letters and digits of labels.

    Lines the run serves from tags are covered whatever the list says. owner has `current`: whether the line is still reported.
    """
    plain = lambda df: df.select(*keys, *([F.col("current")] if "current" in df.columns else []), F.regexp_replace(F.lower(F.col(label)), "[^a-z0-9]+", "").alias("_l"))
    mark = lambda df, name: plain(df).select(*keys, "_l").distinct().withColumn(name, F.lit(True))
    mine = plain(owner).join(mark(fresh, "_f"), [*keys, "_l"], "left").join(mark(tagged, "_x"), [*keys, "_l"], "left")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False))).cast("long")
    f, x, now = F.col("_f"), F.col("_x"), F.col("current")
    agg = mine.groupBy(*keys).agg(n(now).alias("current"), n(now & f).alias("named"), n(now & x & f.isNull()).alias("from_xbrl"), n(f).alias("kept"))
    out = agg.join(fresh.groupBy(*keys).agg(F.count("*").cast("long").alias("fresh")), keys, "left").withColumn("fresh", F.coalesce("fresh", F.lit(0).cast("long")))
    return out.withColumns({"recall": F.round(F.try_divide(F.col("named") + F.col("from_xbrl"), F.col("current")), 6), "precision": F.round(F.try_divide("kept", "fresh"), 6)})


def pending(filings: DataFrame, log: DataFrame, keys: list[str], done: list[str], most: int) -> DataFrame:
    """Filings that are still to be read: never tried, or tried less than `most` times and not done."""
    closed = log.where(F.col("status").isin(*done) | (F.col("attempts") >= most)).select(*keys).distinct()
    return filings.join(closed, keys, "left_anti")


def carried(log: DataFrame, keys: list[str], old: int, new: int, changed: DataFrame) -> DataFrame:
    """The log with filings read under one list version moved to the next without a new reading, where the change doesn't touch them."""
    touched = changed.select(*keys).distinct().withColumn("_t", F.lit(True))
    both = log.join(touched, keys, "left")
    version = F.when((F.col("version") == old) & F.col("_t").isNull(), F.lit(new)).otherwise(F.col("version"))
    return both.withColumn("version", version).drop("_t")


def recorded(stored: DataFrame, reading: DataFrame, filings: DataFrame, keys: list[str], filing: str, unread: DataFrame) -> DataFrame:
    """Stored rows after readings of some filings: a finished reading replaces its filing's rows.

    Rows it no longer produces are rejected, but those of groups that weren't read (unread: filing, group_key) stay.
    filings: those whose reading finished.
    """
    fresh = reading.join(filings.select(filing).distinct(), filing, "left_semi")
    spared = unread.select(filing, "group_key").distinct().withColumn("_s", F.lit(True))
    old = stored.join(fresh.select(*keys), keys, "left_anti").join(filings.select(filing).distinct().withColumn("_f", F.lit(True)), filing, "left").join(spared, [filing, "group_key"], "left")
    status = F.when(F.col("_f") & F.col("_s").isNull(), "rejected").otherwise(F.col("status"))
    return old.withColumn("status", status).select(*stored.columns).unionByName(fresh.select(*stored.columns))


def tallies(counts: list[DataFrame], keys: list[str], n: str) -> DataFrame:
    """Counters of several runs added up."""
    from functools import reduce

    return reduce(DataFrame.unionByName, counts).groupBy(*keys).agg(F.sum(n).cast("long").alias(n))


def trial_summary(values: DataFrame, keys: list[str], status: str, reason: str, most: int = 12) -> DataFrame:
    """(keys, values, verified, share, reason, n): each company's counts beside its most common reasons for review, up to `most`."""
    n = F.count_if(F.col(status) == "verified").cast("long")
    counts = values.groupBy(*keys).agg(F.count("*").cast("long").alias("values"), n.alias("verified")).withColumn("share", F.round(F.col("verified") / F.col("values"), 6))
    reasons = values.where((F.col(status) != "verified") & F.col(reason).isNotNull()).groupBy(*keys, reason).agg(F.count("*").cast("long").alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.col(reason))
    return counts.join(reasons.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most).drop("_k"), keys, "left")


def titled(groups: DataFrame, proposed: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, title): a group's title by rule (column `rule`), else as stored, else as proposed."""
    both = groups.select(*keys, "rule").join(stored.select(*keys, F.col("title").alias("_s")), keys, "left").join(proposed.select(*keys, F.col("title").alias("_p")), keys, "left")
    return both.select(*keys, F.coalesce("rule", "_s", "_p").alias("title"))


def reasons_of(notes: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The reason code of each note, null for display text; rules (code, how, text) are tried in order, how: whole, start, within or pattern."""
    tests = {"whole": lambda n, t: n == t, "start": lambda n, t: n.startswith(t), "within": lambda n, t: n.contains(t), "pattern": lambda n, t: n.rlike(t)}
    return F.transform(notes, lambda n: F.coalesce(*[F.when(tests[how](n, text), code) for code, how, text in rules], F.lit(None).cast("string")))


def only_reasons(codes: Column, allowed: list[str], ignored: list[str]) -> Column:
    """Whether there are codes besides those ignored, and all of them are allowed; display text (null) is a reason of its own."""
    left = F.filter(codes, lambda x: x.isNull() | ~x.isin(*ignored))
    return (F.size(left) > 0) & F.forall(left, lambda x: F.coalesce(x.isin(*allowed), F.lit(False)))
