"""Sums on a grid and matchings against enumeration."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import breakdowns, evaluate, identity
from ledgerloom.operators import sums
from ledgerloom.operators.sums import Sums, only_matching, signed_reach, unit_of


def fewest(values, target, tolerance, least):
    for n in range(least, len(values) + 1):
        if any(abs(sum(s) - target) <= tolerance for s in itertools.combinations(values, n)):
            return n
    return None


@pytest.mark.parametrize("seed", range(60))
def test_smallest_sets_equal_enumeration(seed):
    rnd = random.Random(seed)
    unit = rnd.choice([0.01, 1, 5, 1000])
    values = [rnd.randrange(1, 60) * unit for _ in range(rnd.randrange(1, 11))]
    target, least = rnd.randrange(1, 200) * unit, rnd.choice([1, 2, 3])
    tolerance = rnd.choice([0, 0.4, 2.4]) * unit
    got = Sums(values, target, tolerance).smallest(target, least)
    want = fewest(values, target, tolerance, least)
    if got is None or len(got) < least:
        assert got is None
    # the fewest figures of a sum are looked at; sets of more figures than that but with the same sum are not
    if want is not None and least == 1:
        assert got is not None and len(got) == want and abs(sum(values[i] for i in got) - target) <= tolerance + 1e-9
    if got is not None:
        assert abs(sum(values[i] for i in got) - target) <= tolerance + 1e-9


@pytest.mark.parametrize("seed", range(60))
def test_halves_equal_enumeration(seed):
    rnd = random.Random(seed)
    values = [rnd.randrange(1, 3000) / 100 for _ in range(rnd.randrange(1, 11))]
    target, least, most = rnd.randrange(1, 9000) / 100, rnd.choice([0, 1, 2]), rnd.choice([2, 3, 10])
    tolerance = rnd.choice([0.001, 0.5])
    sizes = [n for n in range(least, most + 1) if any(abs(sum(s) - target) <= tolerance + 1e-9 for s in itertools.combinations(values, n))]
    got = sums.fewest(values, target, tolerance, least, most)
    assert (None if got is None else len(got)) == (sizes[0] if sizes else None)
    assert got is None or abs(sum(values[i] for i in got) - target) <= tolerance + 1e-7


def test_sixty_figures_end_in_seconds():
    rnd = random.Random(1)
    values = [round(rnd.uniform(1e5, 9e6), 2) for _ in range(60)]
    target = sum(values[i] for i in range(0, 60, 3))
    began = time.perf_counter()
    got = Sums(values, target, target * 1e-5).smallest(target)
    assert got and abs(sum(values[i] for i in got) - target) <= 1.25e-5 * target and time.perf_counter() - began < 20


def test_units():
    assert unit_of([1200.0, 300.0]) == 100 and unit_of([0.25, 1.0]) == 0.01 and unit_of([1 / 3]) == 0 and unit_of([]) == 0.01


@pytest.mark.parametrize("seed", range(40))
def test_sign_chains_equal_enumeration(seed):
    rnd = random.Random(seed)
    start, steps, end = rnd.randrange(-50, 50), [rnd.randrange(-20, 20) for _ in range(rnd.randrange(0, 9))], rnd.randrange(-60, 60)
    want = any(abs(start + sum(s * x for s, x in zip(signs, steps)) - end) <= 0.5 for signs in itertools.product((1, -1), repeat=len(steps)))
    assert signed_reach(start, steps, end, 0.5) == want


def test_long_sign_chains(spark):
    steps = [float(3**i) for i in range(12)] + [float(7 * i) for i in range(30)]
    end = 5.0 + sum(steps) - 2 * sum(steps[::4])
    df = spark.createDataFrame([(5.0, steps, end), (5.0, steps, end + 1), (1.0, [], 1.2), (1.0, [2.0, None], 3.0), (None, [1.0], 2.0)], "a double, s array<double>, e double")
    assert [r[0] for r in df.select(evaluate.sign_chain(F.col("a"), F.col("s"), F.col("e"))).collect()] == [True, False, True, None, None]


@pytest.mark.parametrize("seed", range(60))
def test_only_matching_equals_enumeration(seed):
    rnd = random.Random(seed)
    n = rnd.randrange(1, 6)
    allowed = [[j for j in range(n) if rnd.random() < 0.5] for _ in range(n)]
    ways = [p for p in itertools.permutations(range(n)) if all(j in allowed[i] for i, j in enumerate(p))]
    assert only_matching(allowed) == (list(ways[0]) if len(ways) == 1 else None)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_overlaps(spark):
    make = lambda g, t, *v: [(g, k, float(x), None if t is None else float(t)) for k, x in v]
    data = make("one", 100, ("a", 60), ("b", 40), ("c", 25)) + make("two", 100, ("a", 60), ("b", 40), ("c", 25), ("d", 5)) + make("fits", 100, ("a", 60), ("b", 40)) + make("none", 100, ("a", 60), ("b", 43), ("c", 20))
    data += make("no total", None, ("a", 1), ("b", 2), ("c", 3)) + make("first", 90, ("a", 50), ("b", 20), ("c", 20), ("d", 20)) + make("short", 10, ("a", 10), ("b", 10))
    out = rows(breakdowns.drop_overlaps(spark.createDataFrame(data, "g string, k string, v double, t double"), ["g"], "k", "v", "t"))
    left = {g: "".join(r[1] for r in out if r[0] == g) for g in {r[0] for r in out}}
    assert left == {"one": "ab", "two": "ab", "fits": "ab", "none": "abc", "no total": "abc", "first": "acd", "short": "ab"}


def test_partitions_and_trees_of_many_members(spark):
    fine = [(f"leaf{i:02}", 100.0 + 7 * i * i) for i in range(24)]
    whole = sum(v for _, v in fine)
    regions = [(f"region{j}", sum(v for _, v in fine[6 * j : 6 * j + 6])) for j in range(3)]
    df = spark.createDataFrame([("g", k, v, whole) for k, v in fine + regions], "g string, k string, v double, t double")
    out = {r.k: (r.fine, r.coarse) for r in breakdowns.two_partitions(df, ["g"], "k", "v", "t", 1e-6).collect()}
    assert all(out[k][0] for k, _ in fine) and all(out[k] == (False, True) for k, _ in regions)
    assert abs(sum(v for k, v in fine + regions if out[k][1]) - whole) < 1
    twelve = [("all12", sum(v for _, v in fine[:12])), ("six", sum(v for _, v in fine[:6]))]
    distinct = [(k, v * 1000 + 2.0 ** (i % 20)) for i, (k, v) in enumerate(fine)]
    twelve = [("twelve", sum(v for _, v in distinct[:12])), ("six", sum(v for _, v in distinct[:6]))]
    tree = spark.createDataFrame([("g", k, v, k.startswith("leaf"), "segment") for k, v in distinct + twelve], "g string, k string, v double, l boolean, r string")
    above = {r.k: r.parent for r in breakdowns.subtotal_tree(tree, ["g"], "k", "v", "l", "r", 1e-9).collect()}
    assert above == {**{k: "six" if i < 6 else "twelve" if i < 12 else "segment" for i, (k, _) in enumerate(distinct)}, "six": "twelve", "twelve": "segment"}


def test_renaming_of_ten_items(spark):
    names, true = [f"n{i}" for i in range(10)], [f"n{(i + 3) % 10}" for i in range(10)]
    q = spark.createDataFrame([(1, p, a, float(10 * i + s)) for i, a in enumerate(names) for s, p in enumerate(("Q1", "Q2"))], "g int, p string, i string, v double")
    c = spark.createDataFrame([(1, "Q1", b, float(10 * i)) for i, b in enumerate(true)], "g int, p string, i string, v double")
    y = spark.createDataFrame([], "g int, i string, v double")
    assert rows(identity.relabelled(q, c, y, ["g"], "p", "i", "v")) == sorted((1, a, b) for a, b in zip(names, true))
    assert rows(identity.relabelled(q, c.where("i not in ('n1', 'n2')"), y, ["g"], "p", "i", "v")) == []


@pytest.mark.parametrize("size", [1e6, 1e9, 1e11])
def test_large_figures_do_not_widen_the_tolerance(size):
    start, changes = size + 0.25, [1.01 * size + 0.13, 0.97 * size + 0.77, 1.05 * size + 0.01]
    end = start + changes[0] - changes[1] + changes[2]
    assert signed_reach(start, changes, end, 0.5) and signed_reach(start, changes, end + 0.4, 0.5)
    assert not signed_reach(start, changes, end + 7, 0.5) and not signed_reach(start, changes, end - 0.6, 0.5)
