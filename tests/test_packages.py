"""Packages against plain parsing: members, filters, parts of archives, facts and labels."""

import json
import zipfile

from pyspark.sql import functions as F

from ledgerloom.plans import packaged
from ledgerloom.sources import packages

INSTANCE = """<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:t="http://t" xmlns:d="http://d"><context id="a"><entity><identifier scheme="s">77</identifier></entity><period><instant>2024-03-31</instant></period></context>
<context id="b"><entity><identifier scheme="s">77</identifier><segment><d:typedMember dimension="t:Axis"><t:key>x1</t:key></d:typedMember></segment></entity><period><startDate>2024-01-01</startDate><endDate>2024-03-31</endDate></period></context>
<unit id="u"><divide><unitNumerator><measure>iso4217:EUR</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit>
<t:Assets contextRef="a" unitRef="u" decimals="-3">1000</t:Assets><t:Sales contextRef="b" unitRef="u" decimals="INF">-2.5</t:Sales><t:Note contextRef="a">words</t:Note><t:Lost contextRef="gone" unitRef="u">1</t:Lost></xbrl>"""
REPORT = {
    "ContextosPorId": {"c1": {"Periodo": {"FechaInstante": "2024-06-30T00:00:00"}}, "c2": {"Periodo": {"FechaInicio": "2024-01-01", "FechaFin": "2024-06-30"}, "ContieneInformacionDimensional": True}},
    "UnidadesPorId": {"u": {"Medidas": [{"Nombre": "iso4217:MXN"}]}},
    "HechosPorId": {"1": {"IdConcepto": "ifrs-full_Equity", "IdContexto": "c1", "IdUnidad": "u", "ValorNumerico": 5, "Decimales": "-3"}, "2": {"IdConcepto": "ifrs-full_Sales", "IdContexto": "c2", "IdUnidad": "u", "ValorNumerico": "7"}, "3": {"IdConcepto": "other_X", "IdContexto": "c1", "ValorNumerico": 1}},
}


def make(folder, name, files):
    with zipfile.ZipFile(folder / name, "w") as z:
        for member, content in files.items():
            z.writestr(member, content)


def test_members_filters_and_parts(spark, tmp_path):
    for k in range(3):
        make(tmp_path, f"p{k}.zip", {f"d/{i}.xml": f"<a>{k}{i}</a>" * 50 for i in range(7)} | {"notes.txt": "n", "empty/": ""})
    (tmp_path / "other.txt").write_text("no archive")
    whole = packages.members(spark, str(tmp_path))
    assert whole.count() == 24
    parts = packages.members(spark, str(tmp_path), 200)
    assert parts.rdd.getNumPartitions() > 6 and sorted(r.member for r in parts.collect()) == sorted(r.member for r in whole.collect())
    some = whole.where(F.col("member").endswith(".xml") & F.col("archive").isin("p1.zip", "p2.zip") & F.col("member").startswith("d/3") & (F.col("bytes") > 1))
    assert sorted((r.archive, r.member) for r in some.collect()) == [("p1.zip", "d/3.xml"), ("p2.zip", "d/3.xml")]
    assert some.rdd.getNumPartitions() == 2  # the others' archives aren't opened
    empty = tmp_path / "none"
    empty.mkdir()
    assert packages.members(spark, str(empty)).count() == 0


def test_many_small_archives_share_tasks(spark, tmp_path):
    for k in range(150):
        make(tmp_path, f"{k:03}.zip", {"a.xml": f"<a>{k}</a>", "b.txt": "n"})
    make(tmp_path, "077x.zip", {f"{i}.xml": f"<a>{i}</a>" * 50 for i in range(9)})
    parts = packages.members(spark, str(tmp_path), 600)
    size = (tmp_path / "000.zip").stat().st_size
    assert 1 < 600 // size and parts.rdd.getNumPartitions() < 100
    assert sorted((r.archive, r.member) for r in parts.collect()) == sorted([(f"{k:03}.zip", m) for k in range(150) for m in ("a.xml", "b.txt")] + [("077x.zip", f"{i}.xml") for i in range(9)])


def test_facts(spark, tmp_path):
    make(tmp_path, "x.zip", {"i.xml": INSTANCE, "r.json": json.dumps(REPORT), "bad.xml": "<a", "bad.json": "[1]"})
    rows = packages.parsed(packages.members(spark, str(tmp_path)))
    assert sorted(r.member for r in rows.where("kind = 'error'").collect()) == ["bad.json", "bad.xml"]
    got = sorted((r.concept, r.entity, str(r.start), str(r.end), r.dims, r.unit, r.decimals, r.value) for r in packages.facts(rows).collect())
    assert got == [
        ("ifrs-full:Equity", None, "None", "2024-06-30", {}, "MXN", -3, 5.0), ("ifrs-full:Sales", None, "2024-01-01", "2024-06-30", {"dimension": "any"}, "MXN", None, 7.0), ("other:X", None, "None", "2024-06-30", {}, None, None, 1.0),
        ("t:Assets", "77", "None", "2024-03-31", {}, "EUR/shares", -3, 1000.0), ("t:Sales", "77", "2024-01-01", "2024-03-31", {"t:Axis": "x1"}, "EUR/shares", None, -2.5),
    ]
    assert [r.concept for r in packages.plain_facts(packages.facts(rows)).collect()] == ["ifrs-full:Equity"]


def test_labels_are_equal_by_broadcast_and_shuffle(spark, tmp_path):
    for k in range(4):
        make(tmp_path, f"{k}.zip", {"labels.xml": packaged._LABELS.replace("{n}", str(k))})
    names = packages.labels(packages.parsed(packages.members(spark, str(tmp_path))), "en")
    found = spark.createDataFrame([(f"{k}.zip", c) for k in range(5) for c in ("own:Revenue", "own:Other")], "archive string, concept string")
    few, many = (sorted(map(tuple, packages.labelled(found, names, most).collect()), key=repr) for most in (100, 1))
    assert few == many and ("2.zip", "own:Revenue", "Revenue of 2") in few and ("4.zip", "own:Revenue", None) in few and len(few) == 10


def test_archives_are_whole(spark, tmp_path):
    files = spark.createDataFrame([(f"{i % 3}.zip", f"{i}.txt", f"content {i}") for i in range(12)], "archive string, member string, content string")
    to = str(tmp_path / "out")
    for _ in range(2):  # written again, it is the same
        assert sorted((r.archive, r.members) for r in packages.archived(files, to).collect()) == [(f"{k}.zip", 4) for k in range(3)]
    assert sorted((r.archive, r.member, bytes(r.content).decode()) for r in packages.members(spark, to).collect()) == sorted(map(tuple, files.collect()))
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith(".")]
