"""HTML documents as text blocks, tables and cells. Parsing is a small Arrow task for each batch; all else is Spark."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCKS = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "ul", "ol", "section", "article", "br", "title"}
_SKIPPED = {"script", "style", "noscript", "template"}


class _Items(HTMLParser):
    """Text blocks and tables in order. Cells with row or column spans repeat over the places they cover.

    An inner table's rows follow the row that they are in, in the outermost table. Text in a table but in no cell is a
    text block before it. Tables that never end end with the page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[tuple[str, str, list]] = []
        self.text, self.skip, self.tag = [], 0, "p"
        self.tables: list[dict] = []

    def _close(self) -> None:
        t = " ".join("".join(self.text).split())
        if t:
            self.items.append(("text", self.tag, [t]))
        self.text = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in _SKIPPED:
            self.skip += 1
        elif tag == "table":
            if not self._in_cell():
                self._close()
            self.tables.append({"rows": [], "held": {}, "cell": None, "at": 0, "inner": {}, "before": self.text})
            self.text = []
        elif self.tables:
            t = self.tables[-1]
            if tag == "tr":
                self._cell()
                self._close()
                t["rows"].append({})
                t["at"] = 0
            elif tag in ("td", "th"):
                self._cell()
                self._close()
                if not t["rows"]:
                    t["rows"].append({})
                span = [int(x) if (x := a.get(k) or "1").isdigit() else 1 for k in ("rowspan", "colspan")]
                t["cell"] = (max(1, min(span[0], 1000)), max(1, min(span[1], 1000)))
                self.text = []
        elif tag in _BLOCKS:
            self._close()
            self.tag = tag

    def _in_cell(self) -> bool:
        return bool(self.tables) and self.tables[-1]["cell"] is not None

    def _table(self) -> None:
        """Ends the innermost table: its rows are an item's, or go to the table around it."""
        self._cell()
        self._close()
        t = self.tables.pop()
        width = 1 + max((c for r in t["rows"] for c in r), default=-1)
        rows = list(t["inner"].get(-1, []))
        for k, r in enumerate(t["rows"]):
            full = {**r, **{c: x for (i, c), x in t["held"].items() if i == k}}
            rows += [[full.get(c, "") for c in range(width)]] if width else []
            rows += t["inner"].get(k, [])
        self.text = [*t["before"], " "]
        if self.tables:
            outer = self.tables[-1]
            outer["inner"].setdefault(len(outer["rows"]) - 1, []).extend(rows)
        elif width := max(map(len, rows), default=0):
            self.items.append(("table", "table", [[*x, *[""] * (width - len(x))] for x in rows]))

    def close(self) -> None:
        super().close()
        while self.tables:
            self._table()

    def _cell(self) -> None:
        t = self.tables[-1]
        if t["cell"] is None:
            return
        rows, cols = t["cell"]
        text, r = " ".join("".join(self.text).split()), len(t["rows"]) - 1
        while (r, t["at"]) in t["held"]:
            t["rows"][r][t["at"]] = t["held"].pop((r, t["at"]))
            t["at"] += 1
        for c in range(t["at"], t["at"] + cols):
            t["rows"][r][c] = text
            for down in range(1, rows):
                t["held"][r + down, c] = text
        t["at"] += cols
        t["cell"], self.text = None, []

    def handle_endtag(self, tag):
        if tag in _SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif self.tables and tag in ("td", "th", "tr"):
            self._cell()
        elif self.tables and tag == "table":
            self._table()
        elif self._in_cell() and tag in _BLOCKS:
            self.text.append(" ")
        elif tag in _BLOCKS:
            self._close()

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)


def items(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, ordinal, kind text or table, tag, text, rows array<array<string>>) in document order; null html has none."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        from ledgerloom.sources.html import _Items

        for batch in batches:
            out = [[] for _ in range(6)]
            for name, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                p = _Items()
                p.feed(html or "")
                p.close()
                p._close()
                for k, (what, tag, x) in enumerate(p.items):
                    for column, value in zip(out, (name, k, what, tag, x[0] if what == "text" else None, x if what == "table" else None)):
                        column.append(value)
            kinds = (batch.schema.field(0).type, pa.int32(), pa.string(), pa.string(), pa.string(), pa.list_(pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], [id_col, "ordinal", "kind", "tag", "text", "rows"])

    return pages.select(id_col, html_col).mapInArrow(run, f"`{id_col}` {kind}, ordinal int, kind string, tag string, text string, rows array<array<string>>")


def cells(found: DataFrame, id_col: str) -> DataFrame:
    """(id, ordinal, row, col, text) of all tables' cells."""
    tables = found.where("kind = 'table'")
    by_row = tables.select(id_col, "ordinal", F.posexplode("rows").alias("row", "_c"))
    return by_row.select(id_col, "ordinal", "row", F.posexplode("_c").alias("col", "text"))


def title(html_col: str = "html"):
    """The page's title by expression, without a parse."""
    return F.nullif(F.trim(F.regexp_extract(F.col(html_col), r"(?s)<title>(.*?)</title>", 1)), F.lit(""))
