"""Pages laid out as text boxes at coordinates: lines, tables and paragraphs rebuilt from positions.

Rows are found by a sweep over the boxes' heights, tables as islands of lines with figures, columns by the gaps between the
right edges of a table's figures (figures are set flush right). A page stays one row, its boxes and lines arrays in it, so pages
are spread over tasks, only a page's boxes meet, and nothing is sorted, joined or shuffled beyond a page. Arrays are exploded by
outer generators: for others Spark infers a filter on the array, which it moves below and so computes the array in it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import let

#: Units between boxes of one line, between lines of one table, and between right edges of one column.
SAME_LINE, TABLE_GAP, SAME_EDGE = 2.5, 30.0, 14.0
#: Width of a figure's character where boxes have no width of their own.
GLYPH = 5.0
FIGURE = r"^\(?[-–—+]?\$?\s*[0-9][0-9,.]*\s*%?\)?\s*%?$|^[-–—]$"
FOOTNOTE = r"^[0-9]$"


def boxes(pages: DataFrame, keys: list[str], html: str) -> DataFrame:
    """(keys, boxes): of each page the absolutely placed elements that hold text only, as structs of top, left and text; spaces are joined, empty boxes left out.

    A page is searched once: what is found runs from within the style's quotes to the end of the text, so the first quote ends the style and the only `>` begins the text.
    Of several styles in a tag the last one that places it counts; that is asked behind a style found, so tags aren't read backwards.
    """
    placing = r"[^\">]*?(?i:position):\s*(?i:absolute)[^\">]*+\""
    other = rf"(?:(?<=\b(?i:style)=\")|[^>]*\b(?i:style)=\"){placing}"
    found = F.regexp_extract_all(html, F.lit(rf"<(?i:div|span|p)\b[^>]*?\b(?i:style)=\"({placing}(?!{other})[^>]*+>[^<>]*+)<"), F.lit(1))

    def box(x: Column) -> Column:
        at = lambda side: F.regexp_extract(F.substring_index(x, '"', 1), rf"(?i){side}:(?<![^;\s]{side}:)\s*(-?[0-9.]+)px", 1).try_cast("double").alias(side)
        text = F.trim(F.regexp_replace(F.substring_index(x, ">", -1), r"\s{2,}|[^\S ]", " "))
        read = text
        for mark, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            read = F.replace(read, F.lit(mark), F.lit(char))
        return F.struct(at("top"), at("left"), F.when(F.contains(x, F.lit("&")), read).otherwise(text).alias("text"))

    placed = F.filter(F.transform(found, box), lambda b: (b["text"] != "") & b["left"].isNotNull() & b["top"].isNotNull())
    return pages.select(*keys, placed.alias("boxes"))


def _paged(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Pages with their boxes in an array; boxes may also come one to a row (keys, text, left, top)."""
    if "boxes" in placed.columns:
        return placed
    return placed.groupBy(*keys).agg(F.collect_list(F.struct(F.col("top").cast("double").alias("top"), F.col("left").cast("double").alias("left"), "text")).alias("boxes"))


def _starts(items: str, new) -> Column:
    """The places of an array at which a run begins: the first one, and where new(item, the one before, place) says so."""
    return F.filter(F.transform(F.col(items), lambda x, i: F.when((i == 0) | new(x, F.get(F.col(items), i - 1), i), i)), lambda i: i.isNotNull())


def _cut(items: str, starts: str, run) -> Column:
    """run(its first place, its places) of each run. Items are taken by their places, for a slice would read the whole array for each run."""
    return F.transform(F.col(starts), lambda i, k: run(i, F.sequence(i, F.coalesce(F.get(F.col(starts), k + 1), F.size(items)) - 1)))


def lined(placed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lines): lines down the page, each a struct of its top and its cells from left to right (left, text, top, figure). Ties go by text."""
    rows = _paged(placed, keys).select(*keys, F.sort_array("boxes").alias("_b"))
    rows = rows.select(*keys, "_b", _starts("_b", lambda x, before, i: x["top"] - before["top"] > SAME_LINE).alias("_s"))
    at = lambda i: F.get(F.col("_b"), i)
    cell = lambda i: F.struct(at(i)["left"].alias("left"), at(i)["text"].alias("text"), at(i)["top"].alias("top"), at(i)["text"].rlike(FIGURE).alias("figure"))
    return rows.select(*keys, _cut("_b", "_s", lambda i, places: F.struct(at(i)["top"].alias("top"), F.sort_array(F.transform(places, cell)).alias("cells"))).alias("lines"))


def sectioned(placed: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, parts): parts down the page, each an array of lines that are all of one table (`is_table`) or all of one paragraph.

    A line with two figures or more behind its first box is part of a table, and so is one line without between two such
    lines. Lines further apart than TABLE_GAP are of different tables. All other lines next to each other are one paragraph.
    """
    figures = lambda line: F.size(F.filter(line["cells"], lambda c, i: c["figure"] & (i > 0))) >= 2
    rows = lined(placed, keys).select(*keys, "lines", F.transform("lines", figures).alias("_f"))
    at = lambda i: F.get(F.col("lines"), i)
    near = lambda i, j: F.coalesce(F.abs(at(i)["top"] - at(j)["top"]) <= TABLE_GAP, F.lit(False))
    full = lambda i: F.coalesce(F.get(F.col("_f"), i), F.lit(False))
    rows = rows.select(*keys, "lines", F.transform("_f", lambda f, i: f | full(i - 1) & full(i + 1) & near(i - 1, i) & near(i + 1, i)).alias("_t"))
    rows = rows.select(*keys, "lines", "_t", _starts("_t", lambda t, before, i: (t != before) | t & ~near(i - 1, i)).alias("_s"))
    line = lambda i: F.struct(at(i)["top"].alias("top"), at(i)["cells"].alias("cells"), F.get(F.col("_t"), i).alias("is_table"))
    return rows.select(*keys, _cut("lines", "_s", lambda i, places: F.transform(places, line)).alias("parts"))


def read(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, parts): each part of a page as an array of rows (row, cells), cells an array of (column, text); a paragraph is one cell of no row. Rows from 1."""
    lone = lambda c: (F.length(c["text"]) <= 3) & c["text"].rlike(FOOTNOTE)
    edge = lambda c: c["left"] + GLYPH * F.length(c["text"])

    def celled(p: Column, marks: Column) -> Column:
        """Each cell with its right edge, whether it is a lone digit, and whether it is a figure of a column."""
        value = lambda c, i: c["figure"] & (i > 0) & ~(lone(c) & marks)
        cell = lambda c, i: F.struct(c["text"].alias("text"), edge(c).alias("edge"), lone(c).alias("lone"), value(c, i).alias("value"))
        return F.transform(p, lambda x: F.transform(x["cells"], cell))

    def column(c: Column, i: Column, edges: Column, starts: Column) -> Column:
        nearest = lambda: F.array_min(F.transform(edges, lambda e: F.struct(F.abs(e - c["edge"]).alias("d"), e.alias("e"))))["e"]
        label = (i == 0) | c["lone"] & ~c["value"] | (c["edge"] < F.get(edges, F.lit(0)) - SAME_EDGE) & ~c["value"]
        upto = lambda e: F.size(F.filter(starts, lambda o: o <= e))
        # a column's figure stands at its own edge
        return F.when(c["value"], upto(c["edge"])).when(label, 0).otherwise(let(nearest(), lambda n: F.when(n.isNotNull(), upto(n))))

    def joined(line: Column, edges: Column, starts: Column) -> Column:
        placed = F.transform(line, lambda c, i: F.struct(column(c, i, edges, starts).alias("column"), c["text"].alias("text")))
        text = lambda all_, k: F.array_join(F.transform(F.filter(all_, lambda c: c["column"].eqNullSafe(k)), lambda c: c["text"]), " ")
        merged = lambda p, ks: F.transform(ks, lambda k: F.struct(k.alias("column"), text(p, k).alias("text")))
        alone = lambda p, ks: (F.size(ks) == F.size(p)) & ~F.exists(p, lambda c: c["text"].isNull())
        return let(placed, lambda p: let(F.array_distinct(F.transform(p, lambda c: c["column"])), lambda ks: F.when(alone(p, ks), p).otherwise(merged(p, ks))))

    def table(cells: Column) -> Column:
        found = F.sort_array(F.array_distinct(F.transform(F.filter(F.flatten(cells), lambda c: c["value"]), lambda c: c["edge"])))
        begun = lambda edges: F.filter(edges, lambda e, i: (i == 0) | (e - F.get(edges, i - 1) > SAME_EDGE))
        columns = let(found, lambda edges: F.struct(edges.alias("edges"), begun(edges).alias("starts")))
        return let(columns, lambda x: F.transform(cells, lambda line, i: F.struct((i + 1).alias("row"), joined(line, x["edges"], x["starts"]).alias("cells"))))

    def part(p: Column) -> Column:
        marks = F.exists(p, lambda x: F.exists(x["cells"], lambda c: c["figure"] & ~lone(c)))
        whole = F.array_join(F.transform(F.flatten(F.transform(p, lambda x: x["cells"])), lambda c: c["text"]), " ")
        one = F.array(F.struct(F.lit(None).cast("int").alias("row"), F.array(F.struct(F.lit(0).alias("column"), whole.alias("text"))).alias("cells")))
        return F.when(F.get(p, F.lit(0))["is_table"], let(let(marks, lambda m: celled(p, m)), table)).otherwise(one)

    return sections.select(*keys, F.transform("parts", part).alias("parts"))


def rows(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, row, cells): each row of a table with its cells (column, text), each paragraph as one cell of no row; parts and rows from 1."""
    each = read(sections, keys).select(*keys, F.posexplode_outer("parts").alias("part", "_p")).where("_p IS NOT NULL")
    return each.select(*keys, (F.col("part") + 1).alias("part"), F.explode_outer("_p").alias("_r")).where("_r IS NOT NULL").select(*keys, "part", "_r.row", "_r.cells")


def tables(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, row, column, text): cells of all tables; column 0 is the label, figures take columns from 1 by their right edges.

    Figures are all boxes of a figure's form but lone digits beside others (footnote marks), which belong to the label before
    them. Boxes that stand right of a label and aren't figures go to the column whose edge is nearest.
    """
    return rows(sections, keys).where("row IS NOT NULL").select(*keys, "part", "row", F.explode("cells").alias("_c")).select(*keys, "part", "row", "_c.column", "_c.text")


def paragraphs(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, text) of what lies between tables."""
    return rows(sections, keys).where("row IS NULL").select(*keys, "part", F.get("cells", 0)["text"].alias("text"))


def page_text(placed: DataFrame, keys: list[str], unit: float = GLYPH) -> DataFrame:
    """(keys, line, text): each line on a grid of characters, figures flush right at their right edges, other boxes where they begin; at least two spaces between."""

    def add(out: Column, b: Column) -> Column:
        start = F.round(b["left"] / unit).cast("int")
        at = F.when(F.length(out) > 0, F.greatest(start, F.length(out) + 2)).otherwise(F.greatest(start, F.lit(0)))
        return F.concat(F.rpad(out, at, " "), b["text"])

    each = lined(placed, keys).select(*keys, F.posexplode_outer("lines").alias("line", "_l")).where("_l IS NOT NULL")
    return each.select(*keys, (F.col("line") + 1).alias("line"), F.aggregate(F.col("_l.cells"), F.lit(""), add).alias("text"))
