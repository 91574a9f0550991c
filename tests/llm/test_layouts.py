"""Operators 11 to 13 against plain versions: cuts of texts, shards, manifests."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import common, flow, op11_fill_middle, op12_reshard, op13_merkle
from ledgerloom.llm.rankselect import BitRow

from ..conftest import SF
from .helpers import edge_documents, no_documents, rows

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("n, share", [(0, 0.5), (1, 1), (7, 0.5), (512, 1), (513, 0.01), (5000, 0.3), (70_000, 0.001), (2048, 0)])
def test_rank_and_select(n, share):
    bits = np.random.default_rng(n).random(n) < share
    row, ones = BitRow(bits), np.flatnonzero(bits)
    assert row.ones == len(ones)
    places = np.arange(n + 1)
    assert (row.rank(places) == np.concatenate([[0], np.cumsum(bits)])).all()
    assert (row.select(np.arange(len(ones) + 1)) == np.append(ones, n)).all()
    with pytest.raises(IndexError):
        row.select(np.array([len(ones) + 1]))


def plain_middle(doc_id, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text or "")
    n, text = len(units), text or ""
    h = [int(H(f"1:{'' if doc_id is None else doc_id}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle_equals_plain_version(spark):
    marked = [(100 + i, t, "s", 1, "i", "p", "h", "w") for i, t in enumerate(["<P>", "a <S", "S> b", "<<M>>", "x<", ">y <P", "<P <S <M", "aé<é>b"] * 5)]
    docs = edge_documents(spark).union(spark.createDataFrame(marked, edge_documents(spark).schema))
    made = op11_fill_middle.transform(docs)
    got = rows(made.withColumn("back", op11_fill_middle.restored(made.output, made.form)))
    have = [(r.doc_id, r.text) for r in docs.collect()]
    plain = sorted((plain_middle(*x) for x in have), key=repr)
    assert sorted((tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) for r in got), key=repr) == plain
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t in have)
    assert {x[2] for x in plain} == {"plain", "psm", "spm"}
    assert rows(op11_fill_middle.transform(no_documents(spark))) == []


def test_cuts_in_several_rows_of_bits(monkeypatch):
    monkeypatch.setattr(op11_fill_middle, "ROW_BYTES", 50)
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abc é日😀.\n") for _ in range(rnd.randrange(90))) for _ in range(60)] + [None, ""]
    draws = np.array([[rnd.randrange(1 << 32) for _ in range(2)] for _ in texts])
    n, first, middle, first_chars, middle_chars = op11_fill_middle.cuts(pa.array(texts).slice(3), draws[3:])
    for i, t in enumerate(texts[3:]):
        units = re.findall("[A-Za-z]+|[^A-Za-z]", t or "")
        a, b = sorted(int(x) % (len(units) + 1) for x in draws[i + 3])
        p, m = "".join(units[:a]), "".join(units[a:b])
        assert (n[i], first[i], middle[i], first_chars[i], middle_chars[i]) == (len(units), len(p.encode()), len(m.encode()), len(p), len(m))


def cost(moves, zones):
    return sum(f for f in moves.values()), sum(f for (i, j), f in moves.items() if zones and zones[i] != zones[j])


@pytest.mark.parametrize("seed", range(12))
def test_flow_moves_the_fewest_bytes(seed):
    """Against all ways to move units of one byte between three or four shards."""
    rnd = random.Random(seed)
    old = [rnd.randrange(4) for _ in range(3)]
    room = [rnd.randrange(4) for _ in range(4)]
    room[3] += max(0, sum(old) - sum(room))
    zones = [rnd.randrange(2) for _ in range(4)]
    moves = flow.transfers(old, room, zones)
    now = [x + sum(f * ((j == k) - (i == k)) for (i, j), f in moves.items()) for k, x in enumerate(old + [0])]
    assert all(0 <= x <= r for x, r in zip(now, room))
    units = [i for i, x in enumerate(old) for _ in range(x)]
    best = min(
        (sum(a != b for a, b in zip(units, to)), sum(zones[a] != zones[b] for a, b in zip(units, to)))
        for to in itertools.product(range(4), repeat=len(units)) if all(to.count(k) <= room[k] for k in range(4))
    )
    assert cost(moves, zones) == best


def test_flow_needs_room():
    with pytest.raises(ValueError):
        flow.transfers([5, 5], [4, 5])
    assert flow.transfers([0, 0], [0]) == {}


@pytest.mark.parametrize("shards, new", [(8, 10), (10, 6), (4, 4), (1, 7)])
def test_blocks_end_near_equal(shards, new):
    rnd = np.random.default_rng(shards)
    shard = np.sort(rnd.integers(0, shards, 800))
    size = rnd.integers(20, 400, 800)
    size[17] = 30_000
    old = np.bincount(shard, weights=size, minlength=shards).astype(int).tolist()
    total = sum(old)
    now = flow.placed(shard, size, flow.transfers(old, [total // new + (j < total % new) for j in range(new)]), new)
    held = np.bincount(now, weights=size, minlength=new)
    assert len(held) == new
    smallest = [size[now == k].min() for k in range(new)]
    assert all(held[k] - held.min() <= smallest[k] for k in range(new))


def same(a):
    return sorted((repr(sorted(x.items())) for x in a))


def test_reshard_keeps_rows_and_laws(spark, tmp_path):
    docs, at = spark.read.parquet(f"{SF}/documents.parquet").repartition(5), str(tmp_path / "a")
    op12_reshard.write(docs, at, 6)
    before = op12_reshard.manifest(spark, at).toPandas()
    done = op12_reshard.reshard(spark, at, 9)
    after = op12_reshard.manifest(spark, at).toPandas()
    assert done["least"] <= done["moved"] <= done["rewritten"]
    kept = before.merge(after, on=["file", "block"])
    moved = kept[kept.shard_x != kept.shard_y]
    assert moved.bytes_x.sum() == done["moved"] and (kept[~kept.file.isin(moved.file)].version_y == 0).all()
    got = rows(op12_reshard.read(spark, at))
    assert same([r["doc"] for r in got]) == same(rows(docs))
    held = {}
    for r in got:
        assert r["size"] == len((r["doc"]["text"] or "").encode()) + 16
        held.setdefault(r["shard"], []).append(r)
    assert sorted(held) == list(range(9))
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in held.values())
    sizes = [sum(r["size"] for r in x) for x in held.values()]
    assert max(sizes) - min(sizes) <= max(r["size"] for r in got)
    op12_reshard.reshard(spark, at, 4)
    again = rows(op12_reshard.read(spark, at))
    assert same([r["doc"] for r in again]) == same(rows(docs)) and {r["shard"] for r in again} == set(range(4))


def test_reshard_survives_a_failed_version(spark, tmp_path, monkeypatch):
    docs, at = spark.read.parquet(f"{SF}/documents.parquet"), str(tmp_path / "a")
    op12_reshard.write(docs, at, 3)
    whole = same(r["doc"] for r in rows(op12_reshard.read(spark, at)))
    with monkeypatch.context() as broken:
        broken.setattr(op12_reshard, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            op12_reshard.reshard(spark, at, 5)
    assert same(r["doc"] for r in rows(op12_reshard.read(spark, at))) == whole
    op12_reshard.reshard(spark, at, 5)
    assert same(r["doc"] for r in rows(op12_reshard.read(spark, at))) == whole


def test_reshard_edges(spark, tmp_path):
    clash = edge_documents(spark).selectExpr("*", "'x' as shard", "7L as file", "null as version", "1 as slot", "doc_id as `a.b`")
    op12_reshard.write(clash.drop("version"), str(tmp_path / "a"), 3)
    op12_reshard.reshard(spark, str(tmp_path / "a"), 5)
    assert same(r["doc"] for r in rows(op12_reshard.read(spark, str(tmp_path / "a")))) == same(rows(clash.drop("version")))
    op12_reshard.write(no_documents(spark), str(tmp_path / "b"), 3)
    assert op12_reshard.reshard(spark, str(tmp_path / "b"), 5) == {"moved": 0, "least": 0, "rewritten": 0}
    assert rows(op12_reshard.read(spark, str(tmp_path / "b"))) == []


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 16 * 16
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 16])))
        i //= 16
    return out


def plain_merkle(docs):
    lower = lambda t: t and re.sub("[A-Z]", lambda m: m[0].lower(), t)
    leaf = lambda r, t: H("".join(map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], t))))
    groups = {}
    for r in docs:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r["doc_id"], leaf(r, lower(r["text"]))))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for g in names:
        for i, (_, _, own, doc_id, tampered) in enumerate(sorted(groups[g])):
            both = path(trees[g], i) + path(top, names.index(g))
            at = tampered if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 else own
            for left, right in both:
                at = H(left + at + right)
            out.append((doc_id, own, trees[g][-1][0], top[-1][0], H("".join(a + b for a, b in both)), at, at == top[-1][0]))
    return sorted(out, key=repr)


def merkle(spark, monkeypatch, docs):
    monkeypatch.setattr(common, "table", lambda *a: docs)
    return sorted((tuple(r.values()) for r in rows(op13_merkle.op13_merkle(spark, SF))), key=repr)


DOC = "doc_id long, source string, lang string, n_chars long, text string, g string, k long, nodes string, digest string"


def documents(spark, plain):
    return spark.createDataFrame([(*r, "g", 1, "n", "d") for r in plain], DOC)


def test_merkle_edges(spark, monkeypatch):
    """Null and repeated ids, equal rows, sources of one row, of exactly 16 and 17 rows, a null and an empty source, negative and far ids."""
    rnd = random.Random(3)
    plain = [(i, "sixteen", "en", 1, f"T {i}") for i in range(16)] + [(i * 3, "seventeen", "en", None, f"Text {i}") for i in range(17)] + [(7, "lone", None, 3, None)]
    plain += [(None, "ties", "en", 1, f"N{i}") for i in range(3)] + [(5, "ties", "de", 2, f"T{i % 4}") for i in range(40)] + [(5, None, "x", 0, ""), (-9, None, "x", 0, "A"), (1, "", "x", 0, "A")]
    plain += [(rnd.choice([-(2**63), 2**63 - 1, -1, 0, rnd.getrandbits(60)]), "far", "en", 1, "Far É") for _ in range(50)]
    rnd.shuffle(plain)
    docs = documents(spark, plain)
    assert merkle(spark, monkeypatch, docs) == plain_merkle(rows(docs))
    assert merkle(spark, monkeypatch, docs.limit(0)) == []
    assert merkle(spark, monkeypatch, docs.where("source = 'lone'")) == plain_merkle(rows(docs.where("source = 'lone'")))


def test_merkle_of_crowded_ids_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(op13_merkle, "CROWDED", 20)
    monkeypatch.setattr(op13_merkle, "COPIES", 7)
    plain = [(4, "a", "en", 1, f"X{i}") for i in range(120)] + [(4, "a", "en", 1, "Copy")] * 60 + [(i, "a", "en", 1, "Y") for i in range(60)] + [(9, "b", "en", 1, "Copy")] * 30
    docs = documents(spark, plain)
    assert merkle(spark, monkeypatch, docs) == plain_merkle(rows(docs))


def test_merkle_of_many_groups(spark, monkeypatch):
    plain = [(i, f"s{i % 300}é", "en", 1, f"X{i}") for i in range(700)]
    docs = documents(spark, plain)
    assert merkle(spark, monkeypatch, docs) == plain_merkle(rows(docs))


@pytest.mark.parametrize("name", ["op11_fill_middle", "op13_merkle"])
def test_layouts_equal_sql(spark, name):
    import duckdb

    from ledgerloom.llm import catalog

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = rows(catalog.QUERIES[name](spark, SF))
    want = con.execute(catalog.ORACLE_SQL[name]).fetchall()
    names = [x[0] for x in con.description]
    assert same(got) == same(dict(zip(names, r)) for r in want)
