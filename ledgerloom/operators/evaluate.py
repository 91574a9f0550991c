"""Scores of readings against golden values, other readings and removed lists; trees of concepts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def multiset_difference(left: DataFrame, right: DataFrame, keys: list[str], item: str) -> DataFrame:
    """(keys, matched, missing, extra): two readings of a page compared as bags of figures."""
    l = left.groupBy(*keys, item).agg(F.count("*").alias("_l"))  # noqa: E741
    r = right.groupBy(*keys, item).agg(F.count("*").alias("_r"))
    n = l.join(r, [*keys, item], "full").select(*keys, F.coalesce("_l", F.lit(0)).alias("_l"), F.coalesce("_r", F.lit(0)).alias("_r"))
    total = lambda c: F.sum(c).cast("long")
    return n.groupBy(*keys).agg(total(F.least("_l", "_r")).alias("matched"), total(F.greatest(F.col("_l") - F.col("_r"), F.lit(0))).alias("missing"), total(F.greatest(F.col("_r") - F.col("_l"), F.lit(0))).alias("extra"))


def read_class(stored: Column, found: Column, rounded: float = 0.005) -> Column:
    """right, rounded, wrong or held (nothing found) of one re-read figure."""
    return F.when(found.isNull(), "held").when(stored == found, "right").when(F.abs(stored - found) <= rounded * F.abs(stored), "rounded").otherwise("wrong")


def come_back(removed: DataFrame, fresh: DataFrame, group: str, item: str, share: float = 0.5) -> DataFrame:
    """(removed, fresh, common): groups a person removed of which a fresh list names at least a share of the items again."""
    r, f = removed.select(F.col(group).alias("removed"), item), fresh.select(F.col(group).alias("fresh"), item)
    size = removed.groupBy(F.col(group).alias("removed")).agg(F.count("*").alias("_n"))
    common = r.join(f, item).groupBy("removed", "fresh").agg(F.count("*").cast("long").alias("common"))
    return common.join(size, "removed").where(F.col("common") >= share * F.col("_n")).select("removed", "fresh", "common")


def likeness(a: Column, b: Column) -> Column:
    """Shared words of two labels over all their words; 0 without words."""
    from ..functions.labels import words

    x, y = words(a), words(b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.size(F.array_union(x, y)).cast("double")), F.lit(0.0))


def descendants(edges: DataFrame, parent: str, child: str) -> DataFrame:
    """(ancestor, node, depth) for every node below another, down to the last level; edges must not lead in a circle."""
    from .joins import cut

    step = cut(edges.select(F.col(parent).alias("ancestor"), F.col(child).alias("node"), F.lit(1).alias("depth")))
    out, below = step, edges.select(F.col(parent).alias("_p"), F.col(child).alias("_c"))
    d = 1
    while not step.isEmpty():
        if not step.where("ancestor = node").isEmpty():
            raise ValueError(f"edges lead in a circle of {d}")
        d += 1
        step = cut(step.join(below, F.col("node") == F.col("_p")).select("ancestor", F.col("_c").alias("node"), F.lit(d).alias("depth")))
        out = out.union(step)
    return out


def sign_chain(start: Column, changes: Column, end: Column, tolerance: float = 0.5) -> Column:
    """Whether start, with each change added or taken away, can reach end; null if a figure is missing, or if there are too many changes of too fine figures to tell."""

    def run(starts: pa.Array, steps: pa.Array, ends: pa.Array) -> pa.Array:
        from ledgerloom.operators.sums import signed_reach

        rows = zip(starts.to_pylist(), steps.to_pylist(), ends.to_pylist())
        return pa.array([None if a is None or b is None or x is None or None in x else signed_reach(a, x, b, tolerance) for a, x, b in rows], pa.bool_())

    run.__annotations__ = {"starts": pa.Array, "steps": pa.Array, "ends": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "boolean")(start.cast("double"), changes.cast("array<double>"), end.cast("double"))
