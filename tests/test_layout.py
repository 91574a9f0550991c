"""Pages of placed boxes, charts and forms against plain versions."""

import itertools
import random
import re

import numpy as np
import pytest

from ledgerloom.operators import charts, layout, templates


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def page(*placed):
    return "<html>" + "".join(f'<div class="x" style="color:red;position:absolute;left:{x}px;top:{y}px">{t}</div>' for x, y, t in placed) + "</html>"


def test_tables_and_paragraphs(spark):
    html = page(
        (20, 10, "A  title"), (20, 12, ""), (20, 40.5, "Sales &amp; more"), (200, 41.9, "1,200"), (300, 40.5, "(30)"), (20, 60, "Costs"), (150, 60, "3"), (205, 60.0, "950"), (310, 61, "5"),
        (20, 75, "of which"), (20, 90, "Result"), (215, 90, "7"), (305, 90, "25%"), (20, 300, "Next"), (220, 300, "11"), (300, 300, "12"), (20, 330, "The end"), (20, 345, "of it"),
    )
    sections = layout.sectioned(layout.boxes(spark.createDataFrame([("p", html), ("empty", ""), ("none", None)], "k string, html string"), ["k"], "html"), ["k"])
    cells = {(p, r, c): t for _, p, r, c, t in rows(layout.tables(sections, ["k"]))}
    assert cells == {
        (2, 1, 0): "Sales & more", (2, 1, 1): "1,200", (2, 1, 2): "(30)", (2, 2, 0): "Costs 3 5", (2, 2, 1): "950", (2, 3, 0): "of which", (2, 4, 0): "Result 7", (2, 4, 2): "25%",
        (3, 1, 0): "Next", (3, 1, 1): "11", (3, 1, 2): "12",
    }
    assert rows(layout.paragraphs(sections, ["k"])) == [("p", 1, "A title"), ("p", 4, "The end of it")]


def test_pages_are_neither_joined_nor_sorted(spark):
    """Boxes of a page stay in its row: no shuffle, sort, join or filter over the boxes of all pages."""
    pages = spark.createDataFrame([("p", page((20, 10, "A"), (200, 10, "1,200"), (300, 10, "30"))), ("none", None)], "k string, html string")
    placed = layout.boxes(pages, ["k"], "html")
    for out in (layout.page_text(placed, ["k"]), layout.tables(layout.sectioned(placed, ["k"]), ["k"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in ("Exchange", "Join", "Sort ", "Window") if x in plan]


def test_text_on_a_grid(spark):
    placed = spark.createDataFrame([("p", "Label", 10.0, 5.0), ("p", "12", 90.0, 6.0), ("p", "Long label that runs on", 10.0, 20.0), ("p", "3", 60.0, 20.0)], "k string, text string, left double, top double")
    assert rows(layout.page_text(placed, ["k"])) == [("p", 1, "  Label           12"), ("p", 2, "  Long label that runs on  3")]


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_equals_all_permutations(seed):
    rnd = np.random.default_rng(seed)
    n = int(rnd.integers(1, 7))
    m = n + int(rnd.integers(0, 2))
    cost = rnd.integers(0, 12, (n, m)).astype(float)
    got = charts.cheapest(cost)
    assert len(set(got)) == n
    assert cost[np.arange(n), got].sum() == min(cost[np.arange(n), list(p)].sum() for p in itertools.permutations(range(m), n))


def test_charts(spark):
    near = [("25%", 100, 30), ("75%", 130, 30), ("A", 112, 20), ("B", 125, 20)]  # the label nearest to both is needed by one
    data = [("near", *w) for w in near] + [("part", "25%", 0, 9), ("part", "A", 0, 0)] + [("far", "100%", 0, 30), ("far", "A", 200, 20)] + [("twice", "50%", 0, 9), ("twice", "50%", 100, 9), ("twice", "A", 0, 0), ("twice", "A", 100, 0)] + [("none", "A", 0, 0)]
    words = spark.createDataFrame(data, "k string, text string, x int, y int")
    assert rows(charts.labelled_shares(words, ["k"])) == [("near", "A", 25.0), ("near", "B", 75.0)]


def test_charts_are_fitted_many_to_a_batch(spark):
    """A thousand charts are one batch of rows, not a frame each; those whose nearest labels are taken go to the assignment."""
    data = [(k, t, x + k % 3, y) for k in range(1000) for t, x, y in (("40%", 100, 30), ("60%", 160, 30), ("A", 104, 20), ("B", 164 - 60 * (k % 2), 25))]
    out = charts.labelled_shares(spark.createDataFrame(data, "k long, text string, x long, y long"), ["k"])
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in out.collect():
        got.setdefault(r.k, {})[r.label] = r.share
    assert all(got[k] == {"A": 40.0, "B": 60.0} for k in range(0, 1000, 2)) and not any(k in got for k in range(1, 1000, 2))


@pytest.mark.parametrize("seed", range(20))
def test_fitted_equals_the_assignment(seed):
    rnd = random.Random(seed)
    shares = [{"x": rnd.randrange(0, 90), "y": float(rnd.randrange(20, 40)), "share": float(i)} for i in range(rnd.randrange(1, 5))]
    labels = [{"x": rnd.randrange(0, 90), "y": float(rnd.randrange(10, 40)), "text": f"n{i}"} for i in range(len(shares) + rnd.randrange(0, 2))]
    price = lambda s, n: (lambda o, b: (o if o >= 0 else -2 * o) + b / 4 if -charts.BELOW <= o <= charts.ABOVE and b <= charts.BESIDE else charts._FAR)(s["y"] - n["y"], abs(s["x"] - n["x"]))
    least = min(sum(price(s, n) for s, n in zip(shares, p)) for p in itertools.permutations(labels, len(shares)))
    got = charts.fitted(shares, labels)
    assert (got is None) == (least >= charts._FAR)
    if got:
        at = {n["text"]: n for n in labels}
        assert abs(sum(price(s, at[n]) for s, (n, _) in zip(shares, got)) - least) < 1e-9


def like(a, b):
    x, y = (set(re.findall(r"[a-z]+", t.lower())) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 0.0


def best_score(labels, form, least, gap):
    score = [[-gap * (i + j) if not i or not j else 0.0 for j in range(len(form) + 1)] for i in range(len(labels) + 1)]
    for i, j in itertools.product(range(1, len(labels) + 1), range(1, len(form) + 1)):
        k = like(labels[i - 1], form[j - 1])
        score[i][j] = max(score[i - 1][j] - gap, score[i][j - 1] - gap, score[i - 1][j - 1] + k if k >= least else -9)
    return score[-1][-1]


def test_alignments_are_the_best(spark):
    rnd = random.Random(2)
    words = "cash assets total debt other net sales".split()
    form = [(10 * j, " ".join(rnd.sample(words, 2))) for j in range(1, 8)]
    pages = {f"p{p}": [" ".join(rnd.sample(words, rnd.randrange(1, 4))) for _ in range(rnd.randrange(1, 7))] for p in range(12)}
    df = spark.createDataFrame([(p, i, t) for p, x in pages.items() for i, t in enumerate(x)], "p string, row int, label string")
    out = rows(templates.aligned(df, spark.createDataFrame(form, "line int, label string"), ["p"]))
    for p, labels in pages.items():
        pairs = [(r[1], r[2], r[3]) for r in out if r[0] == p]
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(sorted(pairs), sorted(pairs)[1:]))  # neither crosses another
        got = sum(x[2] for x in pairs) - 0.1 * (len(labels) + len(form) - 2 * len(pairs))
        assert abs(got - best_score(labels, [t for _, t in form], 0.5, 0.1)) < 1e-9


def test_rows_out_of_order_have_no_line(spark):
    form = spark.createDataFrame([(1, "total assets"), (2, "total debt"), (3, "net cash")], "line int, label string")
    df = spark.createDataFrame([("p", 1, "Total assets"), ("p", 2, "Net cash"), ("p", 3, "Total debt"), ("p", 4, None), ("q", 1, None)], "p string, row int, label string")
    out = [(r[1], r[2]) for r in rows(templates.aligned(df, form, ["p"]))]
    assert out in ([(1, 1), (2, 3)], [(1, 1), (3, 2)])


def test_gate(spark):
    from ledgerloom.operators import gates

    rules = spark.createDataFrame([("top", "t", 1), ("top", "a", -1), ("top", "b", -1), ("sub", "b", 1), ("sub", "c", -1), ("sub", "d", -1), ("net", "n", 1), ("net", "t", -1), ("net", "x", 1)], "rule string, line string, sign int")
    columns = {
        "right": {"t": 100, "a": 60, "b": 40, "c": 30, "d": 10, "n": 90, "x": 10}, "rounded": {"t": 101, "a": 60, "b": 40}, "wrong": {"t": 100, "a": 60, "b": 45, "c": 35, "d": 10},
        "through": {"t": 100, "a": 60, "c": 30, "d": 10}, "apart": {"t": 100, "a": 60, "c": 30, "d": 20}, "chain": {"a": 60, "c": 30, "d": 10, "n": 90, "x": 10}, "far": {"a": 60, "c": 30, "d": 10, "n": 95, "x": 1}, "few": {"t": 100, "a": 50}, "none": {"q": 1},
    }
    df = spark.createDataFrame([(k, line, float(v), 1.0) for k, c in columns.items() for line, v in c.items()] + [("none", "t", None, 1.0)], "k string, l string, v double, s double")
    out = {r.k: (r.accepted, r.held_rules, ",".join(r.broken)) for r in gates.gated(df, rules, ["k"], "l", "v", "s").collect()}
    assert out == {
        "right": (True, 3, ""), "rounded": (True, 1, ""), "wrong": (False, 1, "top"), "through": (True, 2, ""), "apart": (False, 0, "sub,top"), "chain": (True, 1, ""), "far": (False, 0, "top"), "few": (False, 0, ""), "none": (False, 0, ""),
    }


def test_gated_columns_are_not_broadcast(spark):
    """Only the form's rules are sent to all tasks: what grows with the columns is merged, even where it looks small."""
    from ledgerloom.operators import gates

    rules = spark.createDataFrame([("top", "t", 1), ("top", "a", -1)], "rule string, line string, sign int")
    df = spark.createDataFrame([(k, line, 5.0, 1.0) for k in "xyz" for line in "ta"], "k string, l string, v double, s double")
    out = gates.gated(df, rules, ["k"], "l", "v", "s")
    assert out.where("accepted").count() == 3 and out._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 2


def test_fits_equals_gated(spark):
    """A column in one row is judged as one of rows: all of it printed, some of it missing or printed twice, bounds that meet or don't."""
    from pyspark.sql import functions as F

    from ledgerloom.operators import gates

    listed = [("top", "t", 1), ("top", "a", -1), ("top", "b", -1), ("sub", "b", 1), ("sub", "c", -1), ("sub", "d", -1), ("net", "n", 1), ("net", "t", -1), ("net", "x", 1), ("lone", "n", 1)]
    rnd = random.Random(5)
    columns = {"none": [("q", 1.0)], "null": [("t", None), ("a", 1.0)], "empty": [("t", None)]}
    for k in range(150):
        a, c, d, x = (rnd.randrange(0, 40) for _ in range(4))
        whole = {"t": a + c + d, "a": a, "b": c + d, "c": c, "d": d, "n": a + c + d - x, "x": x, "q": 5}
        some = rnd.sample(sorted(whole), rnd.randrange(1, 9)) + rnd.choice([[], ["a"], ["t", "b"]])
        columns[str(k)] = [(line, float(whole[line] + rnd.choice([0, 0, 0, 0, 1, -4]))) for line in some]
    df = spark.createDataFrame([(k, line, v, 1.0) for k, c in columns.items() for line, v in c], "k string, line string, value double, step double")
    for rules in (listed[:3], listed[:9], listed):
        want = gates.gated(df, spark.createDataFrame(rules, "rule string, line string, sign int"), ["k"], "line", "value", "step")
        got = df.groupBy("k").agg(F.collect_list(F.struct("line", "value", "step")).alias("lines")).select("k", gates.fits(F.col("lines"), rules).alias("f")).select("k", "f.*")
        assert rows(got) == rows(want) and len({r[1] for r in rows(got)}) == 2


def test_served_pages_are_read_once(spark):
    """Pages are laid out in one pass and judged where they lie: the query starts no job of its own, joins nothing and searches each page once."""
    from ledgerloom.plans import served

    from .conftest import SF

    plan = served.pages_to_served(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Join" not in plan and "Scan ExistingRDD" not in plan and plan.count("Exchange") == 3
    assert sum("[(),]" in line for line in plan.splitlines()) == 1  # figures are parsed once, not for a filter of their own too


def test_lines_are_not_sliced(spark):
    """Lines take their boxes by place; a slice reads a page's whole array for each line."""
    pages = spark.createDataFrame([("p", page((20, 10, "A"), (200, 10, "1,200"), (300, 10, "30")))], "k string, html string")
    parts = layout.sectioned(layout.boxes(pages, ["k"], "html"), ["k"])
    assert "slice(" not in parts._jdf.queryExecution().executedPlan().toString()


def test_the_last_style_places(spark):
    tag = lambda *styles: "<p" + "".join(f' {name}="{value}"' for name, value in styles) + ">x</p>"
    at = "position:absolute;left:{0}px;top:{0}px"
    html = [
        tag(("data-style", at.format(1)), ("style", at.format(2))), tag(("style", at.format(3)), ("data-style", "left:4px")), tag(("STYLE", "margin-left:5px; Left: 6px;top:7px;position: Absolute"), ("id", "q")),
        tag(("style", "left:8px;top:8px")), f'<p style="{at.format(9)}">a > b</p>',
    ]
    out = layout.boxes(spark.createDataFrame([("".join(html),)], "html string"), [], "html").first().boxes
    assert [tuple(b) for b in out] == [(2.0, 2.0, "x"), (3.0, 3.0, "x"), (7.0, 6.0, "x")]
