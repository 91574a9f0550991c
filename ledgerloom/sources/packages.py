"""Filing packages: zip archives read member by member, and tagged instances resolved to facts.

`zip_members` is a data source whose partitions are parts of large archives or several small ones, so no row and no task holds a whole large archive;
filters on member names are applied to the archive's directory before anything is unpacked. `parsed` turns members into
rows of contexts, units, facts, arcs, locators and labels; `facts` and `labels` join them.
"""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith, StringStartsWith

#: Bytes of an archive for each partition that reads it.
PART_BYTES = 64_000_000
#: Archives that are read one to a partition, and archives of one partition at most: of many small ones a task reads several.
FEW_ARCHIVES, PART_ARCHIVES = 64, 100
MEMBERS = "archive string, member string, bytes long, content binary"


def _store(path: str):
    """The file system and the path within it of any address that Arrow reaches."""
    from pyarrow.fs import FileSystem

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return FileSystem.from_uri(path if "://" in path else "file://" + path)


class _Part(InputPartition):
    """Parts of archives, each (archive, part, of how many): one part of a large archive, or all of several small ones."""

    def __init__(self, parts: list[tuple[str, int, int]]) -> None:
        self.parts = parts


class _MemberReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.part_bytes = options["path"], int(options.get("partbytes", PART_BYTES))
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes tests of archive and member names; Spark applies the others."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            kind = {EqualTo: "equal", In: "equal", StringStartsWith: "start", StringEndsWith: "end"}.get(type(f))
            if column in ("archive", "member") and kind:
                self.tests.append((column, kind, tuple(f.value) if isinstance(f, In) else (f.value,)))
            else:
                yield f

    def _passes(self, column: str, name: str) -> bool:
        test = {"equal": lambda v: name == v, "start": name.startswith, "end": name.endswith}
        return all(any(test[kind](v) for v in values) for c, kind, values in self.tests if c == column)

    def partitions(self) -> list[InputPartition]:
        from pyarrow.fs import FileSelector

        store, root = _store(self.path)
        archives = [x for x in store.get_file_info(FileSelector(root, recursive=True)) if x.path.endswith(".zip") and self._passes("archive", x.base_name)]
        most = min(PART_ARCHIVES, -(-len(archives) // FEW_ARCHIVES))
        out, own, size = [], [], 0
        for x in sorted(archives, key=lambda x: x.path):
            n = max(1, -(-x.size // self.part_bytes))
            if own and (n > 1 or size + x.size > self.part_bytes or len(own) >= most):
                out.append(_Part(own))
                own, size = [], 0
            if n > 1:
                out += [_Part([(x.path, i, n)]) for i in range(n)]
            else:
                own.append((x.path, 0, 1))
                size += x.size
        return out + [_Part(own)] if own or not out else out

    def read(self, partition: _Part) -> Iterator[tuple]:
        store, _ = _store(self.path)
        for archive, part, parts in partition.parts:
            with store.open_input_file(archive) as f, zipfile.ZipFile(f) as z:
                names = sorted(x.filename for x in z.infolist() if not x.is_dir())
                for name in [x for i, x in enumerate(names) if i % parts == part and self._passes("member", x)]:
                    content = z.read(name)
                    yield archive.rsplit("/", 1)[-1], name, len(content), content


class ZipMembers(DataSource):
    """spark.read.format("zip_members").load(folder): a row for each member of each zip below the folder."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> DataSourceReader:
        return _MemberReader(self.options)


def members(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ZipMembers)
    return spark.read.format("zip_members").option("partBytes", part_bytes).load(path)


def archived(files: DataFrame, to: str) -> DataFrame:
    """Writes files (archive, member, content) as zips, each by one task and under its name only when it is whole; (archive, members, bytes).

    A repeated or retried task writes the same archive again. The result has to be read for anything to be written.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        import uuid

        archive = key[0].as_py()
        store, root = _store(to)
        store.create_dir(root, recursive=True)
        part = f"{root}/.{archive}.{uuid.uuid4().hex}"
        rows = sorted(zip(table["member"].to_pylist(), table["content"].to_pylist()))
        with store.open_output_stream(part) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as z:
            for name, content in rows:
                z.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_DEFLATED)
        store.move(part, f"{root}/{archive}")
        return pa.table({"archive": [archive], "members": pa.array([len(rows)], pa.int32()), "bytes": pa.array([sum(len(c) for _, c in rows)], pa.int64())})

    return files.select("archive", "member", F.col("content").cast("binary")).groupBy("archive").applyInArrow(run, "archive string, members int, bytes long")


_ROWS = {
    "kind": pa.string(), "id": pa.string(), "entity": pa.string(), "start": pa.string(), "end": pa.string(), "dims": pa.map_(pa.string(), pa.string()), "measure": pa.string(), "concept": pa.string(), "context": pa.string(),
    "unit": pa.string(), "decimals": pa.string(), "value": pa.string(), "role": pa.string(), "source": pa.string(), "target": pa.string(), "position": pa.float64(), "lang": pa.string(),
}
PARSED = "archive string, member string, kind string, id string, entity string, start string, end string, dims map<string,string>, measure string, concept string, context string, unit string, decimals string, value string, role string, source string, target string, position double, lang string"
_XLINK = "{http://www.w3.org/1999/xlink}"


def _local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def xml_rows(content: bytes) -> Iterator[dict]:
    """Rows of an instance or a linkbase. Elements are dropped as they end, so a large instance isn't held as a tree."""
    spaces: dict[str, str] = {}
    role, depth = None, 0
    parser = ElementTree.iterparse(__import__("io").BytesIO(content), events=("start", "end", "start-ns"))
    for event, e in parser:
        if event == "start-ns":
            spaces[e[1]] = e[0]
            continue
        tag = _local(e.tag)
        if event == "start":
            depth += 1
            if tag in ("presentationLink", "labelLink", "calculationLink", "definitionLink"):
                role = e.get(f"{_XLINK}role")
            continue
        depth -= 1
        get = lambda x: e.get(f"{_XLINK}{x}")
        text = (e.text or "").strip()
        if tag == "context":
            found = {_local(x.tag): (x.text or "").strip() for x in e.iter()}
            dims = [(x.get("dimension"), (x.text or "").strip() or "".join((y.text or "").strip() for y in x)) for x in e.iter() if _local(x.tag) in ("explicitMember", "typedMember")]
            yield {"kind": "context", "id": e.get("id"), "entity": found.get("identifier"), "start": found.get("startDate"), "end": found.get("endDate") or found.get("instant"), "dims": dims}
        elif tag == "unit":
            yield {"kind": "unit", "id": e.get("id"), "measure": "/".join((x.text or "").strip() for x in e.iter() if _local(x.tag) == "measure")}
        elif e.get("contextRef"):
            space = e.tag[1:].split("}")[0] if e.tag.startswith("{") else ""
            yield {"kind": "fact", "concept": f"{spaces[space]}:{tag}" if spaces.get(space) else tag, "context": e.get("contextRef"), "unit": e.get("unitRef"), "decimals": e.get("decimals"), "value": text}
        elif tag == "loc":
            yield {"kind": "loc", "role": role, "id": get("label"), "concept": (get("href") or "").rsplit("#", 1)[-1]}
        elif tag.endswith("Arc"):
            yield {"kind": "arc", "role": role, "source": get("from"), "target": get("to"), "position": float(e.get("order") or 0)}
        elif tag == "label":
            yield {"kind": "label", "role": get("role"), "id": get("label"), "lang": e.get("{http://www.w3.org/XML/1998/namespace}lang"), "value": text}
        if depth <= 1:
            e.clear()


def json_rows(content: bytes) -> Iterator[dict]:
    """Rows of a report as JSON with facts, contexts and units by id, as Mexico's exchange packs it."""
    report = json.loads(content)
    for i, c in (report.get("ContextosPorId") or {}).items():
        period = c.get("Periodo") or {}
        yield {"kind": "context", "id": i, "start": (period.get("FechaInicio") or "")[:10] or None, "end": (period.get("FechaFin") or period.get("FechaInstante") or "")[:10] or None, "dims": [("dimension", "any")] if c.get("ContieneInformacionDimensional") else []}
    for i, u in (report.get("UnidadesPorId") or {}).items():
        yield {"kind": "unit", "id": i, "measure": "/".join(str(m.get("Nombre") or "") for m in u.get("Medidas") or [])}
    for f in (report.get("HechosPorId") or {}).values():
        value, decimals = f.get("ValorNumerico"), f.get("Decimales")
        yield {"kind": "fact", "concept": (f.get("IdConcepto") or "").replace("_", ":", 1), "context": f.get("IdContexto"), "unit": f.get("IdUnidad"), "decimals": None if decimals is None else str(decimals), "value": None if value is None else str(value)}


def parsed(files: DataFrame) -> DataFrame:
    """Rows of all XML and JSON members (archive, member, content); one that doesn't parse is one row of kind `error`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerloom.sources import packages as own

        for batch in batches:
            for archive, member, content in zip(*(batch.column(c).to_pylist() for c in ("archive", "member", "content"))):
                try:
                    rows = list((own.json_rows if member.lower().endswith(".json") else own.xml_rows)(content))
                except (ElementTree.ParseError, ValueError, AttributeError) as e:
                    rows = [{"kind": "error", "value": str(e)}]
                for at in range(0, len(rows), 10_000):
                    some = rows[at : at + 10_000]
                    columns = [pa.array([archive] * len(some)), pa.array([member] * len(some)), *[pa.array([r.get(c) for r in some], t) for c, t in own._ROWS.items()]]
                    yield pa.RecordBatch.from_arrays(columns, ["archive", "member", *own._ROWS])

    return files.select("archive", "member", "content").mapInArrow(run, PARSED)


def facts(rows: DataFrame) -> DataFrame:
    """(archive, member, concept, entity, start, end, dims, unit, decimals, value) of each numeric fact whose context is there."""
    at = ["archive", "member"]
    own = lambda kind: rows.where(F.col("kind") == kind)
    contexts = own("context").select(*at, F.col("id").alias("context"), "entity", F.col("start").try_cast("date").alias("start"), F.col("end").try_cast("date").alias("end"), "dims")
    units = own("unit").select(*at, F.col("id").alias("unit"), F.col("measure"))
    found = own("fact").select(*at, "concept", "context", "unit", F.col("decimals").try_cast("int").alias("decimals"), F.col("value").try_cast("double").alias("value")).where("value IS NOT NULL")
    joined = found.join(contexts, [*at, "context"]).join(units, [*at, "unit"], "left")
    return joined.select(*at, "concept", "entity", "start", "end", "dims", F.element_at(F.split("measure", ":"), -1).alias("unit"), "decimals", "value")


def plain_facts(found: DataFrame, taxonomy: str = "ifrs-full:") -> DataFrame:
    """Facts without a dimension, of one taxonomy."""
    return found.where((F.size("dims") == 0) & F.col("concept").startswith(taxonomy))


def labels(rows: DataFrame, lang: str, role: str = "http://www.xbrl.org/2003/role/label") -> DataFrame:
    """(archive, element, label): locators joined by label arcs to the resources of a language and role; of several the lowest text."""
    keys = ["archive", "member"]
    own = lambda kind: rows.where(F.col("kind") == kind)
    loc = own("loc").select(*keys, F.col("id").alias("source"), F.regexp_replace("concept", "_", ":").alias("element"))
    arc = own("arc").select(*keys, "source", "target")
    text = own("label").where((F.col("lang") == lang) & (F.col("role") == role)).select(*keys, F.col("id").alias("target"), F.col("value").alias("label"))
    return loc.join(arc, [*keys, "source"]).join(text, [*keys, "target"]).groupBy("archive", "element").agg(F.min("label").alias("label"))


def labelled(found: DataFrame, names: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """Facts with their elements' labels. Up to most_rows labels are broadcast; more of them are joined by a shuffle."""
    few = names.limit(most_rows + 1).count() <= most_rows
    keys = [c for c in ("archive", "concept") if c in names.columns or c == "concept"]
    names = names.withColumnRenamed("element", "concept")
    return found.join(F.broadcast(names) if few else names.hint("shuffle_hash"), keys, "left")
