"""An arithmetic gate: printed columns whose figures fit their form's sums, within what rounding allows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import let
from .joins import cut


def intervals(values: DataFrame, keys: list[str], line: str, value: str, step: str) -> DataFrame:
    """(keys, line, low, high): what a figure rounded to a step may have been. A line printed twice keeps what both allow."""
    half = F.col(step).cast("double") / 2
    each = values.where(F.col(value).isNotNull()).select(*keys, F.col(line).alias("line"), (F.col(value) - half).alias("low"), (F.col(value) + half).alias("high"))
    return each.groupBy(*keys, "line").agg(F.max("low").alias("low"), F.min("high").alias("high"))


def _judged(known: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Each column's rules: low and high of total less signed parts, as far as known, and the lines that are missing."""
    up = F.col("sign") > 0
    hits = known.join(F.broadcast(rules), "line")
    seen = hits.groupBy(*keys, "rule").agg(F.sum(F.when(up, F.col("low")).otherwise(-F.col("high"))).alias("low"), F.sum(F.when(up, F.col("high")).otherwise(-F.col("low"))).alias("high"), F.collect_set("line").alias("_have"))
    whole = rules.groupBy("rule").agg(F.collect_list(F.struct("line", "sign")).alias("_all"))
    return seen.join(F.broadcast(whole), "rule").withColumn("_missing", F.filter("_all", lambda x: ~F.array_contains("_have", x["line"])))


def gated(values: DataFrame, rules: DataFrame, keys: list[str], line: str, value: str, step: str, needed: int = 1, slack: float = 1e-9) -> DataFrame:
    """(keys, accepted, held_rules, broken): whether each column's figures fit the rules, and the rules that broke, in order.

    rules: (rule, line, sign), each a sum that has to be zero: a total with 1, its parts with -1, what is taken off with 1. A line
    that isn't printed is bounded by any rule in which it alone is missing, and that bound takes part in the other rules, round
    by round until nothing is new, at most as often as there are lines. Two bounds of such a line that don't meet break both rules. A rule that alone
    gave a line it needs proves nothing and isn't counted. A column is accepted if no rule broke and at least `needed` held. Rules are a form's, so they are
    broadcast; columns stay spread by their keys.
    """
    rules = rules.select(F.col("rule").cast("string").alias("rule"), F.col("line"), F.col("sign").cast("int").alias("sign"))
    n_lines = rules.select("line").distinct().limit(10_001).count()
    if n_lines > 10_000:
        raise ValueError("a form of more than 10,000 lines")
    known = cut(intervals(values, keys, line, value, step).join(F.broadcast(rules.select("line").distinct()), "line", "left_semi").withColumn("by", F.lit(None).cast("array<string>")))
    for _ in range(n_lines):
        one = _judged(known, rules, keys).where(F.size("_missing") == 1).select(*keys, "rule", F.col("_missing")[0]["line"].alias("line"), F.col("_missing")[0]["sign"].alias("s"), "low", "high")
        # s * x + [low, high] holds zero
        bound = one.select(*keys, "rule", "line", F.when(F.col("s") > 0, -F.col("high")).otherwise(F.col("low")).alias("low"), F.when(F.col("s") > 0, -F.col("low")).otherwise(F.col("high")).alias("high"))
        new = cut(bound.groupBy(*keys, "line").agg(F.max("low").alias("low"), F.min("high").alias("high"), F.collect_set("rule").alias("by")))
        if new.isEmpty():
            break
        # where bounds don't meet, the line is put between them, so that the rules of both sides break
        between = (F.col("low") + F.col("high")) / 2
        apart = F.col("low") > F.col("high")
        known = cut(known.unionByName(new.select(*keys, "line", F.when(apart, between).otherwise(F.col("low")).alias("low"), F.when(apart, between).otherwise(F.col("high")).alias("high"), "by")))
    room = F.greatest(F.abs("low"), F.abs("high"), F.lit(1.0)) * slack
    whole = _judged(known, rules, keys).where(F.size("_missing") == 0).withColumn("broken", (F.col("low") > room) | (F.col("high") < -room))
    untested = known.where(F.size("by") == 1).select(*keys, F.col("by")[0].alias("rule"), F.lit(True).alias("_own")).distinct()
    whole = whole.join(untested.hint("merge"), [*keys, "rule"], "left")
    found = whole.groupBy(*keys).agg(F.count_if(~F.col("broken") & F.col("_own").isNull()).cast("long").alias("held_rules"), F.sort_array(F.collect_list(F.when(F.col("broken"), F.col("rule")))).alias("broken"))
    columns = values.select(*keys).distinct().join(found.hint("merge"), keys, "left")
    held, broken = F.coalesce("held_rules", F.lit(0).cast("long")), F.coalesce("broken", F.array().cast("array<string>"))
    return columns.select(*keys, ((F.size(broken) == 0) & (held >= needed)).alias("accepted"), held.alias("held_rules"), broken.alias("broken"))


def fits(lines: Column, rules: list[tuple[str, str, int]], needed: int = 1, slack: float = 1e-9) -> Column:
    """struct(accepted, held_rules, broken) of a column that lies in one row, by the same laws as `gated`, so nothing is shuffled, joined or written.

    lines: an array of structs of line, value and step. rules: (rule, line, sign) as a list, for the sums of one form are written
    out in the expression; for long lists of rules, or rules in a table, there is `gated`.
    """
    names = sorted({line for _, line, _ in rules})
    parts = {r: [(names.index(line), sign) for x, line, sign in rules if x == r] for r in sorted({r for r, _, _ in rules}, key=str.encode)}
    kind = "struct<low:double,high:double,by:int>"  # by: the only rule that gave a line that isn't printed

    def printed(name: str) -> Column:
        half = lambda x: x["step"].cast("double") / 2
        own = F.filter(lines, lambda x: (x["line"] == name) & x["value"].isNotNull())
        low, high = lambda x: x["value"] - half(x), lambda x: x["value"] + half(x)
        bounds = lambda low, high: F.struct(low.alias("low"), high.alias("high"), F.lit(None).cast("int").alias("by")).cast(kind)
        first = lambda x: F.get(x, F.lit(0))
        return let(own, lambda x: F.when(F.size(x) == 1, bounds(low(first(x)), high(first(x)))).when(F.size(x) > 1, bounds(F.array_max(F.transform(x, low)), F.array_min(F.transform(x, high)))))

    def ends(known: Column, rule: str) -> tuple[Column, Column, Column]:
        """Low and high of a rule's total less signed parts, as far as known, and the number of parts that are missing."""
        at = [(F.get(known, F.lit(i)), sign) for i, sign in parts[rule]]
        total = lambda up, down: reduce(Column.__add__, [F.coalesce(x[up] if sign > 0 else -x[down], F.lit(0.0)) for x, sign in at])
        return total("low", "high"), total("high", "low"), reduce(Column.__add__, [x.isNull().cast("int") for x, _ in at])

    def bounded(known: Column) -> Column:
        """Each missing line with the bounds of all rules in which it alone is missing."""

        def bound(i: int) -> Column:
            own = [(k, [sign for j, sign in parts[r] if j == i][0], ends(known, r)) for k, r in enumerate(parts) if len(parts[r]) > 1 and any(j == i for j, _ in parts[r])]
            if not own:
                return F.get(known, F.lit(i))
            # sign * x + [low, high] holds zero
            offers = F.array(*[F.when(missing == 1, F.struct((-high if sign > 0 else low).alias("low"), (-low if sign > 0 else high).alias("high"), F.lit(k).alias("by"))) for k, sign, (low, high, missing) in own])

            def met(x: Column) -> Column:
                # where bounds don't meet, the line is put between them, so that the rules of both sides break
                low, high = F.array_max(F.transform(x, lambda v: v["low"])), F.array_min(F.transform(x, lambda v: v["high"]))
                end = lambda e: F.when(low > high, (low + high) / 2).otherwise(e)
                return F.when(F.size(x) > 0, F.struct(end(low).alias("low"), end(high).alias("high"), F.when(F.size(x) == 1, F.get(x, F.lit(0))["by"]).alias("by")).cast(kind))

            return F.coalesce(F.get(known, F.lit(i)), let(F.array_compact(offers), met))

        return F.array(*[bound(i) for i in range(len(names))])

    def verdict(known: Column) -> Column:
        each = []
        for k, r in enumerate(parts):
            low, high, missing = ends(known, r)
            own = reduce(Column.__or__, [F.coalesce(F.get(known, F.lit(i))["by"] == k, F.lit(False)) for i, _ in parts[r]])
            room = F.greatest(F.abs(low), F.abs(high), F.lit(1.0)) * slack
            each.append(F.when(missing == 0, F.struct(F.lit(r).alias("rule"), ((low > room) | (high < -room)).alias("broken"), own.alias("own"))))
        return let(F.array_compact(F.array(*each)), told)

    def told(judged: Column) -> Column:
        broken = F.transform(F.filter(judged, lambda x: x["broken"]), lambda x: x["rule"])
        held = F.size(F.filter(judged, lambda x: ~x["broken"] & ~x["own"])).cast("long")
        return F.struct(((F.size(broken) == 0) & (held >= needed)).alias("accepted"), held.alias("held_rules"), broken.alias("broken"))

    gaps = lambda known: F.exists(known, lambda x: x.isNull())
    rounds = lambda known: F.aggregate(F.sequence(F.lit(1), F.lit(len(names))), known, lambda k, _: F.when(gaps(k), bounded(k)).otherwise(k))
    return let(let(F.array(*map(printed, names)), lambda k: F.when(gaps(k), rounds(k)).otherwise(k)), verdict)
