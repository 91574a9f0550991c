"""Charts from word boxes: each share gets a label of its own, all of a chart at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Reach of a label over, under and beside its share; sums that count as a whole.
ABOVE, BELOW, BESIDE = 26.0, 12.0, 45.0
WHOLE = (99.0, 101.0)
_FAR = 1e12


def cheapest(cost: np.ndarray) -> list[int]:
    """The column of each row so that the sum of costs is least; rows are at most as many as columns. In n * n * m steps, by shortest augmenting paths."""
    n, m = cost.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, dtype=int)  # row and column 0 stand for none
    for i in range(1, n + 1):
        owner[0], at = i, 0
        least, way, done = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=bool)
        while True:
            done[at] = True
            row = owner[at]
            reduced = cost[row - 1] - u[row] - v[1:]
            nearer = ~done[1:] & (reduced < least[1:])
            least[1:][nearer], way[1:][nearer] = reduced[nearer], at
            free = np.flatnonzero(~done[1:]) + 1
            nxt = free[least[free].argmin()]
            step = least[nxt]
            u[owner[done]] += step
            v[done] -= step
            least[~done] -= step
            at = nxt
            if owner[at] == 0:
                break
        while at:
            owner[at] = owner[way[at]]
            at = way[at]
    out = [0] * n
    for j in range(1, m + 1):
        if owner[j]:
            out[owner[j] - 1] = j - 1
    return out


def labelled_shares(words: DataFrame, keys: list[str], whole: tuple[float, float] = WHOLE) -> DataFrame:
    """(keys, label, share) of each chart whose shares are a whole and all find a label.

    words: keys, text, x, y (centres, y grows downwards). A label may stand up to ABOVE over its share, at a cost of the
    distance and a quarter of that beside; one below, up to BELOW, costs twice. Labels go to shares so that the sum of costs is least,
    so a label that is near two shares goes where the rest still fits. Charts that name a label twice, miss one or aren't
    whole give no rows. A chart's words are a few dozen and meet in one task.
    """
    share = F.regexp_extract("text", r"^\s*([0-9]{1,3}(?:\.[0-9])?)\s?%\s*$", 1).try_cast("double")
    boxes = words.select(*keys, "text", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), share.alias("share")).where(F.col("share").isNotNull() | F.col("text").rlike(r"\p{L}"))
    shares = F.array_sort(F.collect_list(F.when(F.col("share").isNotNull(), F.struct("y", "x", "share"))))
    labels = F.array_sort(F.collect_list(F.when(F.col("share").isNull(), F.struct("y", "x", "text"))))
    each = boxes.groupBy(*keys).agg(shares.alias("_s"), labels.alias("_l"))
    total = F.aggregate("_s", F.lit(0.0), lambda a, s: a + s["share"])
    each = each.where((F.size("_s") > 0) & (F.size("_s") <= F.size("_l")) & total.between(*whole))

    def run(shares: pa.Array, labels: pa.Array) -> pa.Array:
        from ledgerloom.operators import charts as own

        found = [own.fitted(s, n) for s, n in zip(shares.to_pylist(), labels.to_pylist())]
        return pa.array([None if x is None else [{"label": n, "share": s} for n, s in x] for x in found], pa.list_(pa.struct([("label", pa.string()), ("share", pa.float64())])))

    run.__annotations__ = {"shares": pa.Array, "labels": pa.Array, "return": pa.Array}
    named = F.arrow_udf(run, "array<struct<label:string,share:double>>")("_s", "_l")
    return each.select(*keys, F.explode(named).alias("_n")).select(*keys, "_n.label", "_n.share")


def fitted(shares: list[dict], labels: list[dict]) -> list[tuple[str, float]] | None:
    """The label of each share of a chart, None if one finds none or two the same."""
    cost = []
    for s in shares:
        row = []
        for n in labels:
            if None in (s["x"], s["y"], n["x"], n["y"]):
                row.append(_FAR)
                continue
            over, beside = s["y"] - n["y"], abs(s["x"] - n["x"])
            near = -BELOW <= over <= ABOVE and beside <= BESIDE
            row.append((over if over >= 0 else -2 * over) + beside / 4 if near else _FAR)
        cost.append(row)
    best = [r.index(min(r)) for r in cost]
    # where each share has one label that costs it least, and no two the same one, any other choice costs more
    if len(set(best)) < len(best) or any(r.count(r[i]) > 1 for r, i in zip(cost, best)):
        best = cheapest(np.array(cost))
    names = [labels[i]["text"] for i in best]
    if max(r[i] for r, i in zip(cost, best)) >= _FAR or len(set(names)) < len(names):
        return None
    return [(n, s["share"]) for n, s in zip(names, shares)]
