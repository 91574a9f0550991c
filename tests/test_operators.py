"""Operators on small tables: edges that the queries' SQL doesn't reach."""

import datetime as dt
import itertools
import json
import random
import zipfile

from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, breakdowns, checks, derive, evaluate, identity, joins, selection, sets, store
from ledgerloom.sources import filings, html
from ledgerloom.streaming import ingest

DAY = dt.date(2024, 3, 31)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_within_days_is_a_plain_range_join(spark):
    rnd = random.Random(1)
    days = [DAY + dt.timedelta(rnd.randint(0, 400)) for _ in range(60)]
    left, right = spark.createDataFrame([(i % 3, d) for i, d in enumerate(days)], "k int, a date"), spark.createDataFrame([(i % 3, d) for i, d in enumerate(reversed(days))], "k int, b date")
    for days_, shift in ((12, 0), (12, -365), (0, 7)):
        got = joins.within_days(left, right, ["k"], "a", "b", days_, shift).count()
        want = left.join(right, "k").where(F.abs(F.date_diff("b", F.date_add("a", shift))) <= days_).count()
        assert got == want


def test_within_ratio_is_a_plain_tolerance_join(spark):
    rnd = random.Random(2)
    v = [(i % 4, rnd.uniform(1, 60)) for i in range(200)] + [(0, 0.0), (1, -3.0)]
    left, right = spark.createDataFrame(v, "k int, a double"), spark.createDataFrame(v, "k int, b double")
    for t in (1e-6, 0.01, 0.2):
        want = left.join(right, "k").where("a > 0 and b > 0").where(F.abs(F.col("a") - F.col("b")) <= t * F.col("a")).count()
        assert joins.within_ratio(left, right, ["k"], "a", "b", t).count() == want


def test_one_to_one(spark):
    rnd = random.Random(3)
    pairs = [(a, b, rnd.randint(0, 9)) for a in range(8) for b in range(8) if rnd.random() < 0.6]
    got = rows(joins.one_to_one(spark.createDataFrame(pairs, "a int, b int, s int"), "a", "b", "s"))
    taken, want = set(), []
    for s, a, b in sorted((-s, a, b) for a, b, s in pairs):
        if ("a", a) not in taken and ("b", b) not in taken:
            taken |= {("a", a), ("b", b)}
            want.append((a, b))
    assert len({r["a"] for r in got}) == len(got) == len({r["b"] for r in got}) and {(r["a"], r["b"]) for r in got} <= set(itertools.product(range(8), range(8)))
    assert sum(r["s"] for r in got) == sum(-s for s, a, b in [(-s, a, b) for a, b, s in pairs if (a, b) in set(want)])


def test_parts_vs_total_without_a_total_is_none(spark):
    parts, totals = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "k string, v double"), spark.createDataFrame([("a", 3.0), ("b", 0.0), ("c", 9.0)], "k string, t double")
    assert {r["k"]: r["result"] for r in rows(checks.parts_vs_total(parts, totals, ["k"], "v", "t"))} == {"a": "pass", "b": "none", "c": "none"}


def test_weighted_sum_with_a_missing_child_is_none(spark):
    arcs = spark.createDataFrame([("t", "a", 1.0), ("t", "b", -1.0)], "parent string, child string, weight double")
    facts = spark.createDataFrame([(1, "t", 5.0), (1, "a", 7.0), (1, "b", 2.0), (2, "t", 5.0), (2, "a", 5.0), (3, "t", 9.0), (3, "a", 1.0), (3, "b", 1.0)], "k int, concept string, value double")
    assert {r["k"]: r["result"] for r in rows(checks.weighted_sum(arcs, facts, ["k"], 0.5))} == {1: "pass", 2: "none", 3: "fail"}


def test_missing_periods(spark):
    wide = derive.pivoted(spark.createDataFrame([("a", p, v) for p, v in (("Q1", 1.0), ("Q2", 2.0), ("Q3", 3.0), ("FY", 10.0))] + [("b", "Q1", 1.0), ("b", "FY", 5.0)] + [("c", q, 1.0) for q in derive.QUARTERS], "k string, p string, v double"), ["k"], "p", "v")
    assert sorted((r["k"], r["fiscal_period"], r["value"]) for r in rows(derive.missing_periods(wide, ["k"]))) == [("a", "Q4", 4.0), ("c", "FY", 4.0)]


def test_subsets_by_masks_and_by_halves_agree_with_all_subsets(spark):
    rnd = random.Random(4)
    data, want = [], {}
    for g, n in enumerate([3, 6, 9, 13, 14, 16]):
        v = [(chr(97 + i), float(rnd.randint(1, 10**6))) for i in range(n)]
        target = sum(x for _, x in rnd.sample(v, max(2, n // 4)))
        data += [(g, i, x, target) for i, x in v]
        fit = [c for k in range(2, n + 1) for c in itertools.combinations(range(n), k) if abs(sum(v[i][1] for i in c) - target) <= 1e-9 * target]
        best = min(fit, key=lambda c: (len(c), sum(1 << i for i in c)))
        want[g] = [v[i][0] for i in best]
    got = rows(breakdowns.subsets(spark.createDataFrame(data, "g int, i string, v double, t double"), ["g"], "i", "v", "t", 1e-9))
    assert {r["g"]: r["items"] for r in got} == want


def test_series_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(200, 201)], "a long, b long")
    got = {r["node"]: r["series"] for r in rows(identity.series(edges))}
    assert all(got[i] == 0 for i in range(51)) and got[201] == 200


def test_witnesses(spark):
    d = lambda n: DAY + dt.timedelta(n)
    data = [("one", 1.0, d(0), 0), ("same", 1.0, d(0), 0), ("same", 1.0, d(90), 1), ("same", 7.0, d(99), 2), ("new", 2.0, d(90), 0), ("new", 1.0, d(0), 1), ("later", 1.0, d(0), 0), ("later", 2.0, d(90), 1), ("tie", 4.0, d(0), 0), ("tie", 1.0, d(0), 1)]
    got = rows(selection.witnesses(spark.createDataFrame(data, "k string, v double, filed date, rank int"), ["k"], [F.col("rank")], "v", "filed"))
    assert {r["k"]: (r["v"], r["witness"]) for r in got} == {"one": (1, "single"), "same": (1, "confirmed"), "new": (2, "restated"), "later": (1, "contradicted"), "tie": (4, "restated")}


def test_votes_and_top_level(spark):
    v = spark.createDataFrame([("a", 1, 2, 1), ("a", 2, 1, 5), ("a", 2, 1, 6), ("b", 7, 1, 1)], "k string, c int, w int, day int")
    assert {r["k"]: (r["c"], r["votes"], r["lead"]) for r in rows(aggregates.vote(v, ["k"], "c", "w", "day"))} == {"a": (2, 2, 0), "b": (7, 1, 1)}
    t = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "gone")], "id string, up string")
    assert sorted(r["id"] for r in rows(aggregates.top_level(t, "id", "up"))) == ["a", "d"]


def test_sets(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert sets.only_adds(a, a.union(b), ["k"]) and not sets.only_adds(a, b, ["k"])
    assert {r["k"]: r["v"] for r in rows(sets.first_of_each([a, b], ["k"]))} == {1: "x", 2: "y", 3: "w"}


def test_filing_lists(spark, tmp_path):
    recent = {"accessionNumber": ["a1", "a2", "a3"], "filingDate": ["2024-05-01", "2024-05-02", "2024-05-03"], "reportDate": ["2024-03-31", "", ""], "form": ["10-Q", "8-K", "10-Q/A"], "items": ["", "2.02,9.01", ""], "size": [1, 2, 3]}
    (tmp_path / "x.json").write_text(json.dumps({"cik": "7", "name": "N", "fiscalYearEnd": "1231", "filings": {"recent": recent}}))
    f = filings.filing_lists(spark, str(tmp_path / "x.json"))
    assert f.count() == 3 and [r["accessionNumber"] for r in rows(filings.periodic(f, F.lit("2024-01-01").cast("date")))] == ["a1"]
    ends = spark.createDataFrame([("7", DAY), ("7", dt.date(2023, 12, 31))], "cik string, quarter_end date")
    got = rows(filings.releases(f, ends))
    assert [(r["accessionNumber"], r["quarter_end"], r["confirmed"]) for r in got] == [("a2", DAY, True)]


def test_csv_zips(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("s.csv", "A;B\n1;ção\n".encode("latin-1"))
        z.writestr("readme.txt", "x")
    assert [r["fields"] for r in rows(filings.statement_csv_zips(spark, str(tmp_path / "*.zip")).orderBy("line"))] == [["A", "B"], ["1", "ção"]]


HTML = """<title>T &amp; U</title><p>One <b>two</b></p><script>no()</script><table><tr><th rowspan=2>Seg</th><th colspan="2">2024</th></tr><tr><td>Q1</td><td>Q2</td></tr><tr><td>A</td><td>$ 1</td></tr></table><ul><li>x<li>y</ul>"""


def test_html_items(spark):
    pages = spark.createDataFrame([(1, HTML), (2, None), (3, "plain"), (4, "<table><tr><td>open")], "id int, html string")
    found = html.items(pages, "id", "html").cache()
    got = sorted(rows(found), key=lambda r: (r["id"], r["ordinal"]))
    assert [r["text"] for r in got if r["id"] == 1 and r["kind"] == "text"] == ["T & U", "One two", "x", "y"]
    table = next(r for r in got if r["id"] == 1 and r["kind"] == "table")
    assert table["rows"] == [["Seg", "2024", "2024"], ["Seg", "Q1", "Q2"], ["A", "$ 1", ""]]
    assert [r["text"] for r in got if r["id"] == 3] == ["plain"] and not [r for r in got if r["id"] == 2]
    assert html.cells(found.where("id = 1"), "id").count() == 9


def test_stream_publishes_only_changes_and_keeps_history(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "key string, value double, at timestamp"
    batch = lambda r: spark.createDataFrame([(k, v, dt.datetime(2024, 1, d)) for k, v, d in r], schema).coalesce(1).write.mode("append").parquet(src)
    table = "versions_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    for own in ([("a", 1.0, 1), ("b", 1.0, 1)], [("a", 1.0, 2), ("b", 2.0, 2)], [("a", 3.0, 3), ("c", 1.0, 3)]):
        batch(own)
        ingest.publish(ingest.events(spark, src, schema, "at"), table, ["key"], ["value"], "at", str(tmp_path / "ck")).awaitTermination()
    got = sorted((r["key"], r["value"], r["at"].day) for r in rows(spark.table(table)))
    assert got == [("a", 1.0, 1), ("a", 3.0, 3), ("b", 1.0, 1), ("b", 2.0, 2), ("c", 1.0, 3)]


def test_stream_window_equals_batch(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "user_id long, ts timestamp, value double"
    spark.createDataFrame([(i % 3, dt.datetime(2024, 1, 1 + i % 5, i % 24), float(i)) for i in range(60)], schema).repartition(3).write.parquet(src)
    q = ingest.windowed(ingest.events(spark, src, schema, "ts"), "ts", ["user_id"], "value").writeStream.format("memory").queryName("w_test").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda r: (r["user_id"], r["window_start"])
    assert sorted(rows(spark.table("w_test")), key=key) == sorted(rows(ingest.windowed(spark.read.parquet(src), "ts", ["user_id"], "value")), key=key)


def test_units(spark):
    src = spark.createDataFrame([(i,) for i in range(4)], "id int")
    units = spark.createDataFrame([(0, True, "v2"), (1, False, "v2"), (2, True, "v1")], "id int, complete boolean, version string")
    assert sorted(r["id"] for r in rows(store.to_read(src, units, ["id"], "v2"))) == [1, 2, 3]


def test_ties_long_chains_and_deep_trees_are_followed_to_the_end(spark):
    """A tied block of 30 x 25 beside a chain that takes a round for each link; equal to a plain loop over sorted pairs."""

    pairs = [(a, b, 5) for a in range(30) for b in range(25)] + [(100 + k, 100 + k + d, 50 - 2 * k - d) for k in range(8) for d in (0, 1)]
    want, used_l, used_r = [], set(), set()
    for a, b, s in sorted(pairs, key=lambda x: (-x[2], x[0], x[1])):
        if a not in used_l and b not in used_r:
            want.append((a, b, s))
            used_l.add(a)
            used_r.add(b)
    got = rows(joins.one_to_one(spark.createDataFrame(pairs, "a int, b int, s int"), "a", "b", "s"))
    assert sorted((r["a"], r["b"], r["s"]) for r in got) == sorted(want) and len(want) == 33
    line = spark.createDataFrame([(k, k + 1) for k in range(19)], "p int, c int")
    assert evaluate.descendants(line, "p", "c").count() == 19 * 20 // 2


def test_subsets_of_large_groups(spark):
    data = [("big", f"{i:02d}", float(1 << i), float((1 << 3) + (1 << 20) + (1 << 22))) for i in range(24)]
    data += [("tie", f"{i:02d}", 1.0, 3.0) for i in range(30)] + [("none", f"{i:02d}", 2.0, 999.0) for i in range(22)]
    got = rows(breakdowns.subsets(spark.createDataFrame(data, "g string, i string, v double, t double"), ["g"], "i", "v", "t", 1e-9))
    assert {r["g"]: r["items"] for r in got} == {"big": ["03", "20", "22"], "tie": ["00", "01", "02"]}


def test_nested_and_unclosed_tables_keep_their_content():
    from ledgerloom.sources.html import _Items

    def found(html):
        p = _Items()
        p.feed(html)
        p.close()
        p._close()
        return [(kind, x) for kind, _, x in p.items]

    nested = "<p>top</p><table><tr><td>a <table><tr><td>x<td>y</tr><tr><td>z</table> b</td><td>c</td></tr><tr><td>d</td></tr></table><p>end</p>"
    assert found(nested) == [("text", ["top"]), ("table", [["a b", "c"], ["x", "y"], ["z", ""], ["d", ""]]), ("text", ["end"])]
    assert found("<p>top</p><table><tr><td>a</td></tr><p>after</p> and more") == [("text", ["top"]), ("text", ["after"]), ("text", ["and more"]), ("table", [["a"]])]
    assert found("<table><tr><td><p>a</p><p>b</p></td></tr></table>") == [("table", [["a b"]])]
    assert found("<table><tr><td>a<table><tr><td>x") == [("table", [["a"], ["x"]])]


def test_sign_chain_tries_all_sums(spark):
    frame = spark.createDataFrame([(1.0, [2.0, 4.0], 7.0), (1.0, [2.0, 4.0], 8.0), (0.0, [float(2**k) for k in range(14)], 1.0)], "a double, x array<double>, b double")
    got = [r["ok"] for r in frame.select(evaluate.sign_chain(F.col("a"), F.col("x"), F.col("b"), 0.1).alias("ok")).collect()]
    assert got == [True, False, True]  # 8192 less all the smaller ones is 1
