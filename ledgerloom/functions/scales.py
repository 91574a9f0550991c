"""The scale of a printed figure, from the words nearest to it: its row, a heading, its column, the table, the document.

Each source gives struct(factor, source, words), null where it states nothing; a resolver takes the first that does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .headers import heading
from .numbers import clean, let

TYPE = "struct<factor:double,source:string,words:string>"
# Factors of scale words, by how a word begins; and phrases that state a scale.
FACTORS = {"bil": 1e9, "bn": 1e9, "b": 1e9, "mil": 1e6, "mm": 1e6, "mn": 1e6, "m": 1e6, "tril": 1e12, "thous": 1e3, "k": 1e3, "000": 1e3}
TABLE_SCALE = r"(?i)(?:\b(?:in|amounts in)\s+|\(\s*(?:in\s+)?)(?:[A-Z]{0,3}\$\s*)?(?:in\s+)?(thousands|millions|billions|mn|mm|bn)\b"
ROW_SCALE = r"(?i)\((?:in\s+)?(thousands|millions|billions|trillions)\)|\([^()]*\bin\s+(thousands|millions|billions|trillions)\b[^()]*\)"
ROW_SCALE_SHORT = r"(?i)\(\s*(bil|bn|mil|mm|mn|thous)\.?\s*\)"
COLUMN_SCALE = (
    r"(?i)\(\s*(?:(?-i:[A-Z]{1,3}))?\$?\s*(bil|bn|billions?|mil|mm|mn|millions?|thous|thousands?|000s?)\.?\s*\)"
    r"|\(\s*(?:(?-i:[A-Z]{1,3}))?\$\s*([bmk])\.?\s*\)|(?<![\w.])(?:€|\$|£|¥)\s*(bn|mn|mm|m|k)\b"
)
BARE_SCALE = r"(?i)\b(?:in|amounts in)\s+(thousands|millions|billions|trillions)\s+of\s+(?:euros?|dollars?|US\$|\w+ dollars)"
PER_UNIT = r"(?i)\([^()]*\bper\s+(?:month|year|quarter|day|user|subscriber|member|customer|share|unit|system)\b[^()]*\)|\(\s*(?:US)?[$€£¥]\s*/\s*[A-Za-z]+\s*\)"
PER_UNIT_LINE = (
    r"(?i)\bper\s+(?!cent\b)\w|\$\s*/\s*\w|\bprices?\b|\b(?:package|freight|pound|piece|shipment|passenger|unit|composite)\s+(?:freight\s+|package\s+)?yields?\b|\bARP[AU]\b|\bASP\b"
    r"|\b(?:day|daily)\s?rates?\s*(?:\(|$)|\bADR\b"
)
AMOUNT_WORDS = r"(?i)revenue|net sales|\bsales\b|amounts?|dollars?|\$\s*$"
#: Characters before a passage's quote in which its column heading may stand.
HEADING_REACH = 120


def factor_of(word: Column) -> Column:
    w = F.lower(word)
    return F.coalesce(*[F.when(w.startswith(k), F.lit(f)) for k, f in FACTORS.items()])


def _stated(factor: Column, source: str, words: Column) -> Column:
    return F.when(factor.isNotNull(), F.struct(factor.cast("double").alias("factor"), F.lit(source).alias("source"), F.substring(clean(words), 1, 60).alias("words")))


def _found(text: Column, pattern: str, groups: int) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(text, pattern, i), F.lit("")) for i in range(1, groups + 1)])


def row_scale(text: Column, source: str = "row") -> Column:
    """A row's own scale: units for an amount per unit, its `(in millions)`, `(mil)`, `# (000)` or `($B)`.

    A label of two measures, `Kilowatt / NRSF (in thousands)`, states none for the first.
    """
    second = text.rlike(r"(?i)\w\s+/\s+\w.*\([^()]*\b(?:thousand|million|billion|trillion)s?\b[^()]*\)")
    word = F.coalesce(_found(text, ROW_SCALE, 2), _found(text, ROW_SCALE_SHORT, 1), _found(text, COLUMN_SCALE, 3))
    phrase = F.coalesce(*[F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in (ROW_SCALE, ROW_SCALE_SHORT, COLUMN_SCALE)])
    unit = F.nullif(F.regexp_extract(text, PER_UNIT, 0), F.lit(""))
    return F.when(unit.isNotNull(), _stated(F.lit(1.0), source, unit)).when(~second, _stated(factor_of(word), source, phrase))


def heading_scale(text: Column, source: str = "heading") -> Column:
    """A heading row's scale: scale words only, never the `per share` of a caption."""
    word = F.coalesce(_found(text, ROW_SCALE, 2), _found(text, COLUMN_SCALE, 3))
    phrase = F.coalesce(*[F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in (ROW_SCALE, COLUMN_SCALE)])
    return _stated(factor_of(word), source, phrase)


def _cell(rows: Column, row: Column) -> Column:
    return F.coalesce(F.when(row >= 0, F.get(rows, row)), F.array().cast("array<string>"))


def _has_figures(cells: Column) -> Column:
    rest = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0)))
    return F.exists(rest, lambda c: c.rlike("[0-9]") & ~c.rlike("[A-Za-z]{3}"))


def nearest_heading(rows: Column, row: Column) -> Column:
    """The row just above, if it has a label and no figures; else empty."""
    above = _cell(rows, row - 1)
    return F.when((F.size(above) > 0) & ~_has_figures(above), F.array_join(above, " ")).otherwise("")


def body_scale(rows: Column, row: Column, col: Column) -> Column:
    """struct(own, unsure): the scale of the nearest heading within the table's body above a row.

    Headings are rows without figures below the first row of figures. One that states no scale starts rows of its own:
    a scale further up may or may not reach past it, and is given as unsure.
    """
    first = F.coalesce(F.array_min(F.filter(F.transform(rows, lambda r, i: F.when(_has_figures(r), i)), lambda i: i.isNotNull())), F.size(rows))
    above = F.filter(F.transform(rows, lambda r, i: F.struct(i.alias("i"), r.alias("r"))), lambda x: (x["i"] > first) & (x["i"] < row) & ~_has_figures(x["r"]))
    named = F.transform(F.reverse(above), lambda x: F.struct(heading_scale(F.concat_ws(" ", F.get(x["r"], 0), heading(x["r"], col))).alias("s"), (F.trim(F.get(x["r"], 0)) != "").alias("label")))

    def pick(a: Column) -> Column:
        at = F.array_min(F.filter(F.transform(a, lambda x, i: F.when(x["s"].isNotNull(), i)), lambda i: i.isNotNull()))
        passed = F.exists(F.slice(a, F.lit(1), F.coalesce(at, F.lit(0))), lambda x: x["label"])
        found = F.get(a, at)["s"]
        return F.struct(F.when(~passed, found).alias("own"), F.when(passed, found).alias("unsure"))

    return let(named, pick)


def column_scale(rows: Column, row: Column, col: Column) -> Column:
    """The one scale that the header cells of a column state: `GDV (Bil.)`, `€m`; null for none or several."""
    head = F.slice(rows, F.lit(1), F.least(F.greatest(row, F.lit(1)), F.lit(6)))
    cells = F.transform(F.filter(head, lambda r: F.size(r) > col), lambda r: heading(r, col))
    found = F.filter(F.transform(cells, lambda c: _stated(factor_of(_found(c, COLUMN_SCALE, 3)), "column", F.regexp_extract(c, COLUMN_SCALE, 0))), lambda x: x.isNotNull())
    return let(found, lambda a: F.when(F.size(F.array_distinct(F.transform(a, lambda x: x["factor"]))) == 1, F.get(a, 0)))


def declared_scales(text: Column, source: str) -> Column:
    """array of all scales that a text declares, in order, with the 24 characters before each as `before`."""
    part = lambda i: F.regexp_extract_all(text, F.lit(r"(?s)(.{0,24}?)(" + TABLE_SCALE.replace("(?i)", "(?i:") + "))"), F.lit(i))
    pairs = F.zip_with(part(1), F.zip_with(part(2), part(3), lambda p, w: F.struct(p.alias("p"), w.alias("w"))), lambda b, x: F.struct(b.alias("before"), x["p"].alias("phrase"), x["w"].alias("word")))
    return F.transform(pairs, lambda x: F.struct(x["before"].alias("before"), _stated(factor_of(x["word"]), source, x["phrase"]).alias("s")))


def table_scale(context: Column, rows: Column) -> Column:
    """The scale of a table's caption (its last 160 characters) or header, up to its first row of figures, four rows at most.

    Where it declares one for counts and another for amounts, the amounts' one.
    """
    figures = lambda r: (F.trim(F.coalesce(F.get(r, 0), F.lit(""))) != "") & F.exists(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), lambda c: c.rlike("[0-9]") & ~c.rlike(r"^\s*(?:FY\s*)?(?:19|20)[0-9]{2}\s*$") & ~c.rlike("[A-Za-z]"))
    first = F.coalesce(F.array_min(F.filter(F.transform(rows, lambda r, i: F.when(figures(r), i)), lambda i: i.isNotNull())), F.size(rows))
    head = F.array_join(F.flatten(F.slice(rows, F.lit(1), F.least(first, F.lit(4)))), " ")
    text = F.concat_ws(" ", F.right(F.coalesce(context, F.lit("")), F.lit(160)), head)

    def pick(a: Column) -> Column:
        several = F.size(F.array_distinct(F.transform(a, lambda x: x["s"]["factor"]))) > 1
        amounts = F.filter(a, lambda x: x["before"].rlike(AMOUNT_WORDS))
        return F.coalesce(F.when(several, F.try_element_at(amounts, F.lit(-1))["s"]), F.get(a, 0)["s"])

    return let(declared_scales(text, "table"), pick)


def one_scale(text: Column, source: str) -> Column:
    """The one scale a text declares throughout; null for none or several."""
    return let(declared_scales(text, source), lambda a: F.when(F.size(F.array_distinct(F.transform(a, lambda x: x["s"]["factor"]))) == 1, F.get(a, 0)["s"]))


def cell_amount_scale(rows: Column, context: Column, row: Column, col: Column, label: Column, document: Column) -> Column:
    """An amount's scale in a table: its row's, a heading's above it, its column's, units for a per-unit line, the table's, the document's.

    document: the document's one scale (one_scale). A per-unit line never takes a heading's or a caption's scale.
    """
    unit = label.rlike(PER_UNIT_LINE)
    per_unit = F.when(unit, _stated(F.lit(1.0), "per-unit", F.regexp_extract(label, PER_UNIT_LINE, 0)))
    own = [row_scale(F.array_join(_cell(rows, row), " ")), F.when(~unit, body_scale(rows, row, col)["own"]), column_scale(rows, row, col), per_unit]
    return F.coalesce(*own, table_scale(context, rows), document)


def cell_count_scale(rows: Column, row: Column, col: Column, quoted: Column) -> Column:
    """A count's scale in a table: its row's, its column's, the heading's just above it, one that a reader quotes, else units.

    A caption of the table speaks of its amounts, not its counts.
    """
    own = [row_scale(F.array_join(_cell(rows, row), " ")), column_scale(rows, row, col), row_scale(nearest_heading(rows, row), "heading")]
    return F.coalesce(*own, quoted, F.struct(F.lit(1.0).alias("factor"), F.lit("units").alias("source"), F.lit(None).cast("string").alias("words")))


def preceding_scale(text: Column, at: Column) -> Column:
    """The scale of the last heading such as `($ in billions)` before a place of a text."""
    before = F.substring(text, F.lit(1), F.greatest(at, F.lit(0)))
    last = F.regexp_extract(before, rf"(?s)^.*({ROW_SCALE}|{BARE_SCALE})", 1)
    word = F.coalesce(_found(last, ROW_SCALE, 2), _found(last, BARE_SCALE, 1))
    return _stated(factor_of(word), "passage", last)


def passage_amount_scale(text: Column, at: Column, label: Column, document: Column) -> Column:
    """An amount's scale in a passage: units for a per-unit line, the last heading's before it, the passage's one, the document's."""
    per_unit = F.when(label.rlike(PER_UNIT_LINE), _stated(F.lit(1.0), "per-unit", F.regexp_extract(label, PER_UNIT_LINE, 0)))
    return F.coalesce(per_unit, preceding_scale(text, at), one_scale(text, "block"), document)


def passage_count_scale(before: Column, preceding: Column, label: Column) -> Column:
    """A count's scale in a passage: its label's own, the one right after the last place where the label is named just before it, else units."""
    near = F.right(preceding, F.lit(HEADING_REACH))
    words = F.array_join(F.regexp_extract_all(label, F.lit(r"\w+"), F.lit(0)), r"\W+")
    places = F.when(words != "", F.regexp_extract_all(near, F.concat(F.lit(r"(?is)\b"), words, F.lit(r"\b(?:\s*\([^()]*\))?")), F.lit(0)))
    after = F.regexp_extract(F.try_element_at(places, F.lit(-1)), r"(\([^()]*\))$", 1)
    named = F.when(after.rlike(ROW_SCALE), heading_scale(after))
    return F.coalesce(row_scale(before), named, F.struct(F.lit(1.0).alias("factor"), F.lit("units").alias("source"), F.lit(None).cast("string").alias("words")))


def statement_scale(text: Column) -> Column:
    """struct(money, shares): factors that a statement's heading gives its amounts and its share counts.

    `in millions, except shares in thousands` gives 1e6 and 1e3; shares have the money's scale unless it excepts them.
    """
    money = factor_of(F.nullif(F.regexp_extract(text, TABLE_SCALE, 1), F.lit("")))
    own = factor_of(F.nullif(F.regexp_extract(text, r"(?i)\bshares?\b[^.;]{0,40}?\bin\s+(thousands|millions|billions)\b", 1), F.lit("")))
    apart = text.rlike(r"(?i)\bexcept\b[^.;]*\bshares?\b")
    return F.struct(money.alias("money"), F.coalesce(own, F.when(~apart, money), F.lit(1.0)).alias("shares"))


def proven_scale(raw: Column, witnesses: Column, tolerance: float = 0.005) -> Column:
    """Of 1, 1,000 and 1,000,000 the one scale at which most of the raw figures are those of witnesses; null if none or two do.

    raw, witnesses: arrays of the same lines' figures, printed and known; half of them have to fit.
    """
    def fits(scale: float) -> Column:
        same = F.zip_with(raw, witnesses, lambda r, w: F.coalesce((w != 0) & (F.abs(r * scale - w) <= tolerance * F.abs(w)), F.lit(False)))
        return F.size(F.filter(same, lambda x: x)) * 2 >= F.greatest(F.size(F.filter(witnesses, lambda w: w.isNotNull() & (w != 0))), F.lit(1))

    found = F.filter(F.array(*[F.lit(s) for s in (1.0, 1e3, 1e6)]), lambda s: F.coalesce(*[F.when(s == x, fits(x)) for x in (1.0, 1e3, 1e6)]))
    return F.when(F.size(found) == 1, F.get(found, 0))
