"""Printed rows aligned to the ordered lines of a form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluate import likeness

#: What a row or a line left out costs, against a likeness of 0 to 1 of each pair; pairs below LEAST never stand.
GAP, LEAST = 0.1, 0.5


def aligned(rows: DataFrame, form: DataFrame, keys: list[str], label: str = "label", order: str = "row", line: str = "line", least: float = LEAST, gap: float = GAP) -> DataFrame:
    """(keys, row, line, likeness): each page's rows paired with a form's lines in the order of both.

    Of all ways to pair rows and lines without crossing, the one with the greatest sum of likenesses less gaps, found by one pass
    over the table of prefixes in Spark expressions: a page is one row of its arrays, so pages are spread and each
    takes rows times lines steps. A row that stands out of the form's order has no partner. Ties take the pair, then leave out the
    row. form: (line, label), a few hundred lines at most, beside each page. Null labels are like none.
    """
    page = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(label).alias("l")))).alias("_r"))
    lines = [tuple(x) for x in form.orderBy(line).select(line, label).limit(1001).collect()]
    if len(lines) > 1000:
        raise ValueError("a form of more than 1,000 lines")
    kind = form.schema[line].dataType.simpleString()
    named = F.array(*[F.struct(F.lit(n).cast(kind).alias("n"), F.lit(t).cast("string").alias("l")) for n, t in lines])
    like = F.transform("_r", lambda r: F.transform(named, lambda n: F.coalesce(likeness(r["l"], n["l"]), F.lit(0.0))))
    page = page.withColumn("_like", like)
    # a cell: score and the way it came by, 0 pair, 1 row left out, 2 line left out; cell 0 of a row stands before the first line
    cell = lambda score, way: F.struct(score.alias("s"), F.lit(way).alias("w"))
    top = F.transform(F.sequence(F.lit(0), F.lit(len(lines))), lambda j: F.struct((j.cast("double") * -gap).alias("s"), F.lit(2).alias("w")))

    def next_row(above, likes):
        first = F.array(cell(F.get(above, F.lit(0))["s"] - gap, 1))

        def add(done, x):
            pair = F.when(x["k"] >= least, F.get(above, x["j"])["s"] + x["k"])
            up, left = F.get(above, x["j"] + 1)["s"] - gap, F.element_at(done, -1)["s"] - gap
            best = F.greatest(pair, up, left)
            return F.concat(done, F.array(F.struct(best.alias("s"), F.when(pair == best, 0).when(up == best, 1).otherwise(2).alias("w"))))

        return F.aggregate(F.transform(likes, lambda k, j: F.struct(k.alias("k"), j.alias("j"))), first, add)

    ways = F.aggregate(
        "_like", F.struct(top.alias("last"), F.array().cast("array<array<int>>").alias("ways")),
        lambda a, likes: F.transform(F.array(next_row(a["last"], likes)), lambda r: F.struct(r.alias("last"), F.concat(a["ways"], F.array(F.transform(r, lambda c: c["w"]))).alias("ways")))[0],
        lambda a: a["ways"],
    )
    page = page.withColumn("_ways", ways)
    start = F.struct(F.size("_r").alias("i"), F.lit(len(lines)).alias("j"), F.array().cast("array<struct<i:int,j:int>>").alias("p"))

    def back(a, _):
        way = F.when(a["i"] == 0, 2).when(a["j"] == 0, 1).otherwise(F.get(F.get("_ways", a["i"] - 1), a["j"]))
        moved = F.struct((a["i"] - F.when(way < 2, 1).otherwise(0)).alias("i"), (a["j"] - F.when(way != 1, 1).otherwise(0)).alias("j"), F.when(way == 0, F.concat(a["p"], F.array(F.struct((a["i"] - 1).alias("i"), (a["j"] - 1).alias("j"))))).otherwise(a["p"]).alias("p"))
        return F.when((a["i"] == 0) & (a["j"] == 0), a).otherwise(moved)

    pairs = F.aggregate(F.sequence(F.lit(1), F.size("_r") + len(lines)), start, back, lambda a: a["p"])
    each = page.select(*keys, "_r", "_like", F.explode(pairs).alias("_p"))
    return each.select(*keys, F.get("_r", F.col("_p.i"))["o"].alias(order), F.get(named, F.col("_p.j"))["n"].alias(line), F.get(F.get("_like", F.col("_p.i")), F.col("_p.j")).alias("likeness"))
