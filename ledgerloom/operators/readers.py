"""Figures read from tables and texts: by pointers, by last quarter's rows and sentences, by regulators' layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import member_key, quote_template, row_label, sideless_key
from ..functions.numbers import parse_number, statement_number
from .joins import newest_per_key

_FIGURE = r"\(?[-+]?\$?[0-9][0-9,]*(?:\.[0-9]+)?\)?%?|[—–-]"


def dot_leader_rows(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, line, label, figures): lines `label ..... 1,234 5,678` of a text, their figures in order; three dots at least."""
    lines = texts.select(*keys, F.posexplode(F.split(text, "\n")).alias("line", "_t")).where(F.col("_t").rlike(r"\.{3,}"))
    rest = F.regexp_extract("_t", r"\.{3,}\s*(.*)$", 1)
    out = lines.select(*keys, "line", F.trim(F.regexp_extract("_t", r"^(.*?)\s*\.{3,}", 1)).alias("label"), F.regexp_extract_all(rest, F.lit(f"(?<!\\S)({_FIGURE})(?!\\S)"), F.lit(1)).alias("figures"))
    return out.where((F.col("label") != "") & (F.size("figures") > 0))


def text_run_rows(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, row, label, figures) of a table that arrives as running text: a run of two to eight years, then labels each with as many figures.

    The text behind the years is taken apart at its blanks; each run of figures that is long enough belongs to the words
    before it, from behind their last digit, bracket or currency mark on. Dashes are figures, but shorter runs of dashes alone are
    words. Windows over a text's tokens, so time is in proportion to its length.
    """
    head = r"((?:(?:19|20)[0-9]{2}\s+){1,7}(?:19|20)[0-9]{2})\s+(.*)$"
    rows = texts.select(*keys, F.size(F.split(F.regexp_extract(text, head, 1), r"\s+")).alias("_n"), F.regexp_extract(text, head, 2).alias("_rest")).where("_rest <> ''")
    tokens = rows.select(*keys, "_n", F.posexplode(F.split(F.trim(F.regexp_replace("_rest", r"(?<=[0-9)])\s+%", "%")), r"\s+")).alias("_at", "_t"))
    in_order = Window.partitionBy(*keys).orderBy("_at")

    def runs(df: DataFrame, figure: Column, name: str) -> DataFrame:
        changes = F.coalesce(figure != F.lag(figure).over(in_order), F.lit(True)).cast("int")
        return df.withColumn(name, F.sum(changes).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))

    of = lambda name: Window.partitionBy(*keys, name)
    tokens = runs(tokens.withColumn("_f", F.col("_t").rlike(f"^(?:{_FIGURE})$")), F.col("_f"), "_r")
    tokens = tokens.withColumn("_f", F.col("_f") & ((F.count("*").over(of("_r")) >= F.col("_n")) | F.bool_or(F.col("_t").rlike("[0-9]")).over(of("_r"))))
    tokens = runs(tokens, F.col("_f"), "_r")
    each = tokens.groupBy(*keys, "_r").agg(F.first("_f").alias("_f"), F.first("_n").alias("_n"), F.transform(F.sort_array(F.collect_list(F.struct("_at", "_t"))), lambda x: x["_t"]).alias("_x"))
    by_run = Window.partitionBy(*keys).orderBy("_r")
    words = F.regexp_replace(F.regexp_replace(F.array_join(F.lag("_x").over(by_run), " "), r"(?s)^.*[0-9$(]", ""), "^[^A-Za-z]+", "")
    found = each.withColumn("label", words).where(F.col("_f") & (F.size("_x") >= F.col("_n")) & (F.col("label") != ""))
    return found.select(*keys, (F.row_number().over(by_run) - 1).alias("row"), "label", F.slice("_x", F.lit(1), F.col("_n")).alias("figures"))


def text_lines(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, line, level, label, figures) of laid-out text: two blanks or more part chunks, trailing chunks of figures are the row's, indentation its level."""
    lines = texts.select(*keys, F.posexplode(F.split(text, "\n")).alias("line", "_t")).where(F.trim("_t") != "")
    chunks = F.split(F.trim("_t"), r"\s{2,}")
    is_figure = lambda x: statement_number(x).isNotNull()
    last = F.coalesce(F.array_max(F.transform("_c", lambda x, i: F.when(~is_figure(x) & ~x.rlike(r"^[$()%]+$"), i))), F.lit(-1))
    rows = lines.withColumn("_c", chunks).withColumn("_k", last)
    label = F.array_join(F.slice("_c", F.lit(1), F.col("_k") + 1), " ")
    figures = F.filter(F.slice("_c", F.col("_k") + 2, F.size("_c")), is_figure)
    return rows.select(*keys, "line", (F.length("_t") - F.length(F.ltrim("_t"))).alias("level"), label.alias("label"), figures.alias("figures")).where("label <> ''")


def is_positioned(content: Column) -> Column:
    """Pages of absolutely placed text without table rows: over 300 placements in the first 400,000 characters."""
    head = F.lower(F.substring(content, 1, 400_000))
    return ~head.contains("<tr") & (F.size(F.split(head, "position:absolute")) - 1 > 300)


def is_slides(content: Column) -> Column:
    """Words hidden under two slide images or more, and no tables."""
    hidden = F.size(F.regexp_extract_all(content, F.lit(r"(?i)(font-size:\s*1px|visibility:\s*hidden)"), F.lit(1)))
    return ~F.lower(content).contains("<table") & (hidden >= 2)


def caption_only(label: Column) -> Column:
    """A row that is a scale's caption and no line; one that names share counts before the scale is a heading."""
    caption = r"(?i)^\(?[^()]*\b(?:in\s+)?(?:thousands|millions|billions)\b[^()]*\)?$"
    return label.rlike(caption) & ~label.rlike(r"(?i)(?:\bshares\b|weighted[-\s]average).*\b(?:thousands|millions|billions)\b") & ~label.rlike("[0-9]{2}")


def by_region(cells: Column, regions: list[str]) -> Column:
    """Whether a statement's heading cells name two regions or more: it is laid out by segment."""
    found = F.filter(F.array(*map(F.lit, regions)), lambda r: F.exists(cells, lambda c: F.lower(c).contains(r)))
    return F.size(found) >= 2


def located(locators: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, item, value, problem) of pointers to cells: the cell's number times the pointer's scale, or why there is none.

    locators: keys, item, tbl, row, col, scale, label; cells: keys, tbl, row, col, text. no_cell, no_figure; other_row where
    the row's label isn't the one the pointer names.
    """
    c = cells.select(*keys, "tbl", "row", "col", F.col("text").alias("_t"))
    head = cells.where("col = 0").select(*keys, "tbl", "row", row_label(F.col("text")).alias("_l"))
    both = locators.join(c, [*keys, "tbl", "row", "col"], "left").join(head, [*keys, "tbl", "row"], "left")
    n = parse_number(F.col("_t"))["value"]
    other = F.col("label").isNotNull() & F.col("_l").isNotNull() & (member_key(F.col("label")) != member_key(F.col("_l"))) & (sideless_key(F.col("label")) != sideless_key(F.col("_l")))
    problem = F.when(F.col("_t").isNull(), "no_cell").when(n.isNull(), "no_figure").when(other, "other_row")
    return both.select(*keys, "item", F.when(problem.isNull(), F.round(n * F.coalesce("scale", F.lit(1.0)), 6)).alias("value"), problem.alias("problem"))


def replayed(last: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, item, tbl, row, text, problem): last quarter's rows found again by label in this quarter's tables, their column the same.

    By the exact key, else by the key without the side of a gain or loss; a row found in no table, or in several, isn't
    read. A dash is a figure for nothing. last: keys, item, label, col; cells: keys, tbl, row, col, text.
    """
    rows = cells.where("col = 0").select(*keys, "tbl", "row", member_key(row_label(F.col("text"))).alias("_exact"), sideless_key(row_label(F.col("text"))).alias("_side"))
    figures = cells.where(parse_number(F.col("text")).isNotNull() | F.col("text").rlike(r"^\s*\$?\s*[—–-]+\s*$")).select(*keys, "tbl", "row", "col", "text")
    have = rows.join(figures, [*keys, "tbl", "row"])
    asks = last.select(*keys, "item", "col", member_key(F.col("label")).alias("_exact"), sideless_key(F.col("label")).alias("_side"))
    exact = asks.drop("_side").join(have.drop("_side"), [*keys, "col", "_exact"]).select(*keys, "item", "tbl", "row", "text")
    rest = asks.join(exact.select(*keys, "item"), [*keys, "item"], "left_anti")
    sided = rest.drop("_exact").join(have.drop("_exact"), [*keys, "col", "_side"]).select(*keys, "item", "tbl", "row", "text")
    found = exact.union(sided).withColumn("_n", F.count("*").over(Window.partitionBy(*keys, "item")))
    one = found.where("_n = 1").drop("_n").withColumn("problem", F.lit(None).cast("string"))
    many = found.where("_n > 1").select(*keys, "item").distinct().withColumn("problem", F.lit("found more than once"))
    none = asks.select(*keys, "item").join(found.select(*keys, "item"), [*keys, "item"], "left_anti").withColumn("problem", F.lit("not found"))
    return one.unionByName(many, allowMissingColumns=True).unionByName(none, allowMissingColumns=True)


def replayed_table(parts: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, grp, tbl, first_row, last_row, total_row): the table that has all rows of last quarter's, the total row last.

    parts: keys, grp, label, total_label; of several tables the first. Rows added since lie above the total.
    """
    rows = cells.where("col = 0").select(*keys, "tbl", "row", member_key(row_label(F.col("text"))).alias("_k"))
    wanted = parts.groupBy(*keys, "grp").agg(F.count_distinct(member_key(F.col("label"))).alias("_n"), F.first(member_key(F.col("total_label"))).alias("_t"))
    met = parts.select(*keys, "grp", member_key(F.col("label")).alias("_k")).join(rows, [*keys, "_k"]).groupBy(*keys, "grp", "tbl").agg(F.count_distinct("_k").alias("_m"), F.min("row").alias("first_row"), F.max("row").alias("last_row"))
    full = met.join(wanted, [*keys, "grp"]).where("_m = _n")
    totals = rows.select(*keys, "tbl", F.col("_k").alias("_t"), F.col("row").alias("total_row"))
    with_total = full.join(totals, [*keys, "tbl", "_t"]).where("total_row > last_row").withColumn("last_row", F.col("total_row") - 1)
    return newest_per_key(with_total, [*keys, "grp"], [F.col("tbl"), F.col("total_row")]).select(*keys, "grp", "tbl", "first_row", "last_row", "total_row")


def replayed_quotes(last: DataFrame, sentences: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, item, sentence): last quarter's sentences found again by their template; of a template in several sentences nothing."""
    now = sentences.select(*keys, "sentence", quote_template(F.col("sentence")).alias("_t"))
    found = last.select(*keys, "item", quote_template(F.col("quote")).alias("_t")).join(now, [*keys, "_t"])
    return found.withColumn("_n", F.count("*").over(Window.partitionBy(*keys, "item"))).where("_n = 1").select(*keys, "item", "sentence")


def anchored(text: Column, words: Column) -> Column:
    """The one figure that a phrase leads to in a text, null for none or several; words: the phrase's words, lower case."""
    escaped = F.transform(words, lambda w: F.concat(F.lit(r"\Q"), w, F.lit(r"\E")))
    pattern = F.concat(F.lit(r"(?i)\b"), F.array_join(escaped, r"[^A-Za-z0-9]{1,6}"), F.lit(r"(?:[^A-Za-z0-9$€£¥(.]|\.(?![0-9])){0,4}((?:US\$|NT\$|[$€£¥])?\s?\(?[0-9](?:[0-9,]*[0-9])?(?:\.[0-9]+)?\)?(?:\s?(?:percent|trillion|billion|million|thousand)\b|%)?)"))
    found = F.regexp_extract_all(text, pattern, F.lit(1))
    return F.when(F.size(found) == 1, F.trim(F.get(found, 0)))


def quoted_rows(last: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, item, value_text): last quarter's quoted rows found again by label and number of figures, the figure in the same place.

    last: keys, item, label, figures (how many), place; lines: keys, label, figures (texts). Labels with a footnote number
    run into them are equal; a label that several lines of the shape have isn't read.
    """
    bare = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"(?<=[a-z)])[0-9]{1,2}(?:,[0-9]{1,2})*$", "")
    now = lines.select(*keys, bare(F.col("label")).alias("_l"), F.size("figures").alias("_n"), "figures")
    both = last.select(*keys, "item", bare(F.col("label")).alias("_l"), F.col("figures").alias("_n"), "place").join(now, [*keys, "_l", "_n"])
    one = both.withColumn("_m", F.count("*").over(Window.partitionBy(*keys, "item"))).where("_m = 1")
    return one.select(*keys, "item", F.get("figures", F.col("place")).alias("value_text")).where(parse_number(F.col("value_text")).isNotNull())


def earlier_twins(tables: DataFrame, keys: list[str], order: str, rows: str = "rows") -> DataFrame:
    """(keys, order, twin): the first earlier table of the same words in its header and labels and with other figures."""
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "[0-9$%.,()]+", " "), r"\s+", " "))
    shape = F.to_json(F.struct(F.transform(F.get(rows, 0), bare).alias("h"), F.transform(F.slice(rows, F.lit(2), F.size(rows)), lambda r: bare(F.get(r, 0))).alias("l")))
    full = (F.size(F.filter(F.get(rows, 0), lambda x: bare(x) != "")) >= 2) & (F.size(F.filter(F.slice(rows, F.lit(2), F.size(rows)), lambda r: bare(F.get(r, 0)) != "")) >= 2)
    t = tables.where(full).select(*keys, order, F.sha2(shape, 256).alias("_s"), F.sha2(F.to_json(rows), 256).alias("_r"))
    both = t.join(t.select(*keys, F.col(order).alias("twin"), "_s", F.col("_r").alias("_q")), [*keys, "_s"]).where((F.col("twin") < F.col(order)) & (F.col("_r") != F.col("_q")))
    return both.groupBy(*keys, order).agg(F.min("twin").alias("twin"))


def release_lines(members: DataFrame, rows: DataFrame, keys: list[str], tolerance: str = "tol", least: int = 2) -> DataFrame:
    """(keys, tbl, member, value): a release's table that has every line of a breakdown, each proven by its year-ago figure, adding up to the total.

    members: keys, member, year_ago (or null); rows: keys, tbl, member (null for the total), value, prior, tolerance. Two
    lines have to be compared at least.
    """
    n = members.groupBy(*keys).agg(F.count("*").alias("_n"))
    met = members.join(rows.where("member IS NOT NULL"), [*keys, "member"])
    known = F.col("year_ago").isNotNull()
    ok = ~known | F.coalesce(F.abs(F.col("prior") - F.col("year_ago")) <= F.col(tolerance), F.lit(False))
    agg = met.groupBy(*keys, "tbl").agg(F.count_distinct("member").alias("_m"), F.bool_and(ok).alias("_ok"), F.count_if(known).alias("_c"), F.sum("value").alias("_s"), F.max(tolerance).alias("_tol"))
    totals = rows.where("member IS NULL").select(*keys, "tbl", F.col("value").alias("_t"))
    good = agg.join(n, keys).join(totals, [*keys, "tbl"]).where((F.col("_m") == F.col("_n")) & F.col("_ok") & (F.col("_c") >= least) & (F.abs(F.col("_s") - F.col("_t")) <= F.col("_tol") * F.col("_n")))
    first = newest_per_key(good, keys, [F.col("tbl")]).select(*keys, "tbl")
    return met.join(first, [*keys, "tbl"], "left_semi").select(*keys, "tbl", "member", "value")


def earlier_quarters(columns: DataFrame, keys: list[str], own_end: Column, additive: Column) -> DataFrame:
    """(keys, end, value): a row's three-month columns but the release's own, and for additive amounts six months less the three that end the same day.

    columns: keys, end, months, value. A reported quarter goes before a worked-out one.
    """
    three = columns.where("months = 3 AND value IS NOT NULL").select(*keys, "end", "value")
    told = three.where(F.col("end") != own_end)
    half = columns.where("months = 6 AND value IS NOT NULL").where(additive).select(*keys, "end", F.col("value").alias("_h"))
    worked = half.join(three, [*keys, "end"]).select(*keys, F.last_day(F.add_months("end", -3)).alias("end"), (F.col("_h") - F.col("value")).alias("value"))
    return told.union(worked.join(told.select(*keys, "end"), [*keys, "end"], "left_anti"))


def quarter_rows(texts: DataFrame, keys: list[str], text: str, label: str, offset: int = 0) -> DataFrame:
    """(keys, y, q, value): a row's figures under a run of quarter headings `Q2 2022 Q3 2022 ...` in a text; offset 1 skips a footnote number."""
    run = r"((?:\bQ[1-4]\s+(?:19|20)[0-9]{2}\s+){1,7}Q[1-4]\s+(?:19|20)[0-9]{2}\b)(.*)$"
    part = lambda i: F.regexp_extract(text, run, i)
    heads = F.zip_with(F.regexp_extract_all(part(1), F.lit(r"Q([1-4])\s+([0-9]{4})"), F.lit(2)), F.regexp_extract_all(part(1), F.lit(r"Q([1-4])\s+([0-9]{4})"), F.lit(1)), lambda y, q: F.struct(y.cast("int").alias("y"), q.cast("int").alias("q")))
    figures = F.regexp_extract(F.regexp_extract(part(2), rf"(?<![A-Za-z])\Q{label}\E((?:\s+(?:\(?-?[0-9,]*\.?[0-9]+\)?|[—–-]))+)", 1), r"^\s*(.*)$", 1)
    cells = F.slice(F.split(figures, r"\s+"), F.lit(offset + 1), F.size(heads))
    pairs = F.arrays_zip(heads.alias("h"), F.transform(cells, statement_number).alias("v"))
    return texts.where(figures != "").select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.h.y", "_p.h.q", F.col("_p.v").alias("value")).where("value IS NOT NULL AND y IS NOT NULL")


def fact_names(concept: Column, label: Column, members: Column) -> Column:
    """A fact as a reader sees it: `Label [Concept] | Member`, the concept's words where it has no label."""
    words = lambda x: F.regexp_replace(F.regexp_replace(F.element_at(F.split(x, ":"), -1), "Member$", ""), "([a-z0-9])([A-Z])", "$1 $2")
    name = F.element_at(F.split(concept, ":"), -1)
    some = F.array_join(F.transform(members, words), " · ")
    return F.concat(F.coalesce(label, words(concept)), F.lit(" ["), name, F.lit("]"), F.when(some != "", F.concat(F.lit(" | "), some)).otherwise(""))


def unit_fits(item_unit: Column, fact_unit: Column, label: Column, concept: Column) -> Column:
    """Whether a fact's unit can be an item's: money for amounts, none for the rest, per share only where the label says so, counts of things only for counts."""
    f = F.lower(fact_unit)
    money = f.contains("iso4217") | f.rlike("^(?:usd|eur|jpy|twd|gbp|cny)$") | f.startswith("usd")
    per_share = f.contains("share") & (f.contains("/") | f.contains("per"))
    wrong = (per_share & ~F.lower(label).contains("per share")) | (F.element_at(F.split(concept, ":"), -1).startswith("NumberOf") & (item_unit != "count"))
    return ~wrong & F.when(item_unit == "currency", money).otherwise(~money)


def coded_forms(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, statement, scope, code, position, label, value) of a regulator's coded forms (part, scope, scale, code, label, value).

    Amounts are in the form's scale, per-share codes (3.99) in units; lines by dotted code; all-zero statements are left out.
    """
    statement = F.when(F.col("part").isin("BPA", "BPP"), "balance").when(F.col("part") == "DRE", "income").when(F.col("part").isin("DFC_MI", "DFC_MD"), "cash_flow")
    unit = F.when(F.col("code").rlike(r"^3\.99(?:\.|$)"), 1.0).when(F.upper("scale") == "UNIDADE", 1.0).when(F.upper("scale").rlike("^MILH"), 1e6).otherwise(1e3)
    order = F.transform(F.split("code", r"\."), lambda x: x.try_cast("int"))
    each = rows.select(*keys, statement.alias("statement"), "scope", "code", "label", (F.col("value") * unit).alias("value"), order.alias("_o")).where("statement IS NOT NULL")
    some = F.bool_or(F.col("value") != 0).over(Window.partitionBy(*keys, "statement", "scope"))
    w = Window.partitionBy(*keys, "statement", "scope").orderBy("_o", "code")
    return each.withColumn("_some", some).where("_some").select(*keys, "statement", "scope", "code", F.row_number().over(w).alias("position"), "label", "value")


def report_columns(rows: DataFrame, keys: list[str], year: Column, month: Column, annual: Column) -> DataFrame:
    """(keys, statement, concept, start, end, value) of a regulator's JSON report: fixed amount fields give the periods.

    rows: keys, statement, concept, thstrm_amount, frmtrm_amount, thstrm_add_amount. A quarter's report gives its three
    months and its year to date, a year's report the year and the one before; balances at the end and the last year end.
    """
    end = F.last_day(F.make_date(year, month, F.lit(1)))
    opened, quarter = F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.greatest(month - 2, F.lit(1)), F.lit(1))
    balance, flow = F.col("statement") == "balance", F.col("statement") == "cash_flow"
    none = F.lit(None).cast("date")
    own = F.struct(F.when(balance, none).when(annual | flow, opened).otherwise(quarter).alias("start"), end.alias("end"), F.col("thstrm_amount").alias("value"))
    before = F.struct(F.when(~balance, F.make_date(year - 1, F.lit(1), F.lit(1))).alias("start"), F.when(balance, F.make_date(year - 1, F.lit(12), F.lit(31))).otherwise(F.add_months(end, -12)).alias("end"), F.when(balance | annual | flow, F.col("frmtrm_amount")).alias("value"))
    to_date = F.struct(opened.alias("start"), end.alias("end"), F.when(~balance & ~annual & ~flow & (month > 3), F.col("thstrm_add_amount")).alias("value"))
    return rows.select(*keys, "statement", "concept", F.explode(F.array(own, before, to_date)).alias("p")).select(*keys, "statement", "concept", "p.*").where("value IS NOT NULL")


def schedule(text: Column) -> Column:
    """struct(end, period_type, multiplier, assets, income) of a tagged financial schedule; null without a period end."""
    tag = lambda n: F.nullif(F.trim(F.regexp_extract(text, rf"<{n}>\s*([^<\n]*)", 1)), F.lit(""))
    day = F.coalesce(F.try_to_timestamp(tag("PERIOD-END"), F.lit("MMM-dd-yyyy")), F.try_to_timestamp(F.initcap(F.lower(tag("PERIOD-END"))), F.lit("MMM-dd-yyyy"))).cast("date")
    amount = lambda n: F.when(F.regexp_replace(tag(n), "[(),-]", "").try_cast("double").isNotNull(), F.regexp_replace(tag(n), "[(),-]", "").try_cast("double") * F.when(tag(n).rlike(r"^[(-]"), -1).otherwise(1))
    multiplier = F.coalesce(F.nullif(amount("MULTIPLIER"), F.lit(0.0)), F.lit(1.0))
    found = F.struct(day.alias("end"), tag("PERIOD-TYPE").alias("period_type"), multiplier.alias("multiplier"), (amount("TOTAL-ASSETS") * multiplier).alias("assets"), (amount("NET-INCOME") * multiplier).alias("income"))
    return F.when(day.isNotNull(), found)


def translated_columns(columns: DataFrame, keys: list[str], reporting: Column) -> DataFrame:
    """(keys, col): columns that repeat another's period in another currency than the reporting one: convenience translations."""
    other = columns.select(*keys, "period", F.col("currency").alias("_c"), F.col("col").alias("_k"))
    both = columns.join(other, [*keys, "period"]).where((F.col("col") != F.col("_k")) & (F.col("_c") == reporting) & (F.col("currency") != reporting))
    return both.select(*keys, "col").distinct()


def scopes_side_by_side(columns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, col, side): which side of a table each dated column is on; a new side begins where a date comes again."""
    w = Window.partitionBy(*keys).orderBy("col")
    seen = F.array_contains(F.coalesce(F.collect_list("period").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.array().cast("array<string>")), F.col("period"))
    nth = F.row_number().over(Window.partitionBy(*keys, "period").orderBy("col"))
    return columns.withColumn("_again", seen).withColumn("side", nth.cast("int")).select(*keys, "col", "side")


def segment_parts(members: DataFrame, other: DataFrame, totals: DataFrame, keys: list[str], tolerance: float = 0.001) -> DataFrame:
    """(keys, item, value): segments' income, and reconciling items that together close the gap to the total, else the one that closes it alone, else one left-over row.

    members, other: keys, item, value; totals: keys, total. A unit at least is close; segments that fit have no more rows.
    """
    m = members.groupBy(*keys).agg(F.sum("value").alias("_m"), F.count("*").alias("_n")).where("_n >= 2")
    gap = m.join(totals, keys).select(*keys, (F.col("total") - F.col("_m")).alias("_gap"), F.greatest(F.abs("total") * tolerance, F.lit(1.0)).alias("_slack"))
    items = other.join(gap, keys)
    together = items.groupBy(*keys, "_gap", "_slack").agg(F.sum("value").alias("_s")).where(F.abs(F.col("_s") - F.col("_gap")) <= F.col("_slack")).select(*keys)
    alone = items.where(F.abs(F.col("value") - F.col("_gap")) <= F.col("_slack")).join(together, keys, "left_anti")
    one = newest_per_key(alone, keys, [F.abs(F.col("value") - F.col("_gap")), F.col("item")]).select(*keys, "item", "value")
    all_ = other.join(together, keys, "left_semi").select(*keys, "item", "value")
    closed = all_.union(one)
    rest = gap.where(F.abs("_gap") > F.col("_slack")).join(closed.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit("left over").alias("item"), F.col("_gap").alias("value"))
    return members.join(gap, keys, "left_semi").select(*keys, "item", "value").union(closed.join(gap.where(F.abs("_gap") > F.col("_slack")), keys, "left_semi")).union(rest)


def chart_labels(words: DataFrame, keys: list[str], most: float = 14.0) -> DataFrame:
    """(keys, share, label): each percentage of a chart's word boxes with the nearest label above it, within so many points, else below; one share each.

    words: keys, text, x, y (y grows downwards). Boxes meet in cells of the grid, so only near ones are compared.
    """
    is_share = F.col("text").rlike(r"^[0-9]+(?:\.[0-9]+)?%$")
    cell = lambda c, d=0: (F.floor(F.col(c) / (4 * most)) + d).cast("long")
    shares = words.where(is_share).select(*keys, F.col("text").alias("share"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    near = F.explode(F.array(*[F.struct((F.floor(F.col("_x") / (4 * most)) + i).cast("long").alias("cx"), (F.floor(F.col("_y") / (4 * most)) + j).cast("long").alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    asks = shares.withColumn("_c", near).select(*keys, "share", "_x", "_y", "_c.cx", "_c.cy")
    labels = words.where(~is_share & F.col("text").rlike("[A-Za-z]")).select(*keys, F.col("text").alias("label"), "x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    both = asks.join(labels, [*keys, "cx", "cy"]).withColumn("_d", F.col("_y") - F.col("y"))
    above = F.col("_d").between(0, most)
    fit = both.withColumn("_r", F.struct((~above).alias("below"), F.abs(F.col("_d")), F.abs(F.col("_x") - F.col("x")), "label")).where(F.abs("_d") <= 2 * most)
    best = fit.groupBy(*keys, "share", "_x", "_y").agg(F.min_by("label", "_r").alias("label"))
    n = F.count("*").over(Window.partitionBy(*keys, "label"))
    return best.withColumn("_n", n).where("_n = 1").select(*keys, "share", "label")


def rule_changes(stored: DataFrame, again: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, was, now, change) of stored figures read again by today's rules: lost, changed or rounded (within half a percent); equal ones are left out."""
    both = stored.select(*keys, F.col(value).alias("was")).join(again.select(*keys, F.col(value).alias("now")), keys, "left")
    near = F.abs(F.col("was") - F.col("now")) <= 0.005 * F.abs("was")
    change = F.when(F.col("now").isNull(), "lost").when(F.col("now") == F.col("was"), None).when(near, "rounded").otherwise("changed")
    return both.withColumn("change", change).where("change IS NOT NULL")


def stated_basis(text: Column) -> Column:
    """The accounting basis a document states: the auditors' opinion's, else the first that its statements are prepared on."""
    names = {"IFRS": r"international financial reporting standards|\bIFRS\b", "US GAAP": r"u\.?s\.? gaap|accounting principles generally accepted in the united states", "ROC GAAP": r"generally accepted in the republic of china"}
    of = lambda t: F.coalesce(*[F.when(t.rlike(f"(?i){p}"), n) for n, p in names.items()])
    opinion = F.nullif(F.regexp_extract(text, r"(?is)in our opinion.{0,400}?in (?:conformity|accordance) with (.{0,160})", 1), F.lit(""))
    prepared = F.nullif(F.regexp_extract(text, r"(?is)(?:prepared|presented)\s+(?:in (?:conformity|accordance) with|under|on the basis of)\s+(.{0,160})", 1), F.lit(""))
    return F.coalesce(of(opinion), of(prepared))


def registrant_words(cover: Column) -> Column:
    """The words of a registrant's name as its cover prints them before `(Exact name of registrant ...)`, lower case, legal forms left out."""
    name = F.regexp_extract(cover, r"(?is)([^()]{3,150}?)\s*\((?:exact\s+)?name\s+of\s+registrant", 1)
    last = F.trim(F.element_at(F.split(name, r"\n"), -1))
    each = F.regexp_extract_all(F.lower(last), F.lit(r"(\p{L}[\p{L}\p{N}&']*)"), F.lit(1))
    return F.filter(F.array_distinct(each), lambda w: ~w.isin("inc", "corp", "corporation", "company", "co", "ltd", "limited", "plc", "sa", "nv", "ag", "the", "of", "and"))


def explains(quote: Column, label: Column, forms: Column) -> Column:
    """Whether a quote can explain a sharp change: it gives a cause, speaks neither of the future nor of another period, and states the figure (one of its forms) or names the item."""
    from ..functions.headers import OTHER_PERIOD
    from ..functions.labels import forward_looking

    cause = r"(?i)driven|due to|because|as a result|result(?:ed|ing)? (?:of|from)|reflect|includ|exclud|acqui|divest|dispos|sale of|sold|restat|split|transfer|launch|impact|primarily|led by|attributable|following|completion|merger|reduction|change in|recovery|record"
    plain = F.filter(F.regexp_extract_all(F.lower(label), F.lit("([a-z][a-z0-9-]+)"), F.lit(1)), lambda w: (F.length(w) > 2) & ~w.isin("other", "total", "revenue", "revenues", "growth", "net", "income", "fees", "fee", "the", "and", "quarter", "sales", "year", "over"))
    names = F.exists(plain, lambda w: F.array_contains(F.regexp_extract_all(F.lower(quote), F.lit("([a-z][a-z0-9-]+)"), F.lit(1)), w))
    states = F.exists(forms, lambda f: F.array_contains(F.regexp_extract_all(quote, F.lit(r"([0-9][0-9,]*(?:\.[0-9]+)?)"), F.lit(1)), f))
    return (F.length(quote) >= 20) & quote.rlike(cause) & ~forward_looking(quote) & ~quote.rlike(OTHER_PERIOD) & (states | names)


def locator_record(fields: dict[str, Column]) -> Column:
    """A figure's provenance as one JSON text, without the fields it has none for."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "true"})


def row_numbers(cells: Column, col: Column) -> Column:
    """The numbers of a row as printed, the read cell's first; cells of words have none."""
    n = lambda c: F.when(~c.rlike("[A-Za-z]{3}"), parse_number(c)["value"])
    rest = F.filter(F.transform(cells, lambda c, i: F.when(i != col, n(c))), lambda x: x.isNotNull())
    return F.concat(F.array(n(F.get(cells, col))), rest)


def unit_record(fields: list[str]) -> Column:
    """A read unit as canonical JSON, fields in order of their names, and its digest."""
    text = F.to_json(F.struct(*[F.col(f) for f in sorted(fields)]))
    return F.struct(text.alias("record"), F.sha2(text, 256).alias("digest"))


def not_empty(releases: DataFrame, memory: DataFrame, keys: list[str], accession: str, patterns: str) -> DataFrame:
    """Releases but those that an earlier run, under the same title patterns, found to hold nothing."""
    return releases.join(memory.where(F.col("patterns") == patterns).select(*keys, accession).distinct(), [*keys, accession], "left_anti")


def common_bases(years: DataFrame, nines: DataFrame, keys: list[str], basis: str) -> DataFrame:
    """(keys): years and nine months that share an accounting basis, so that a quarter can be worked out."""
    return years.select(*keys, basis).distinct().join(nines.select(*keys, basis).distinct(), [*keys, basis]).select(*keys).distinct()


def asked_of(last: DataFrame, listed: DataFrame, keys: list[str], group: str, item: str, whole: str) -> DataFrame:
    """Last quarter's pointers to what a reading was asked for: listed items, and whole tables' rows of listed groups."""
    items = last.join(listed.select(*keys, group, item).distinct(), [*keys, group, item], "left_semi")
    rows = last.where(F.col(whole)).join(listed.select(*keys, group).distinct(), [*keys, group], "left_semi").join(listed.select(*keys, group, item), [*keys, group, item], "left_anti")
    return items.unionByName(rows)


def distinct_evidence(marks: DataFrame, keys: list[str], start: str, least: int = 2) -> DataFrame:
    """(keys, starts): evidence from periods with `least` different starts at least."""
    return marks.groupBy(*keys).agg(F.count_distinct(start).cast("long").alias("starts")).where(F.col("starts") >= least)


def served_snapshot(chosen: DataFrame, keys: list[str], lines: str) -> DataFrame:
    """(keys, snapshot): each company's chosen statements as one JSON array, newest period first."""
    each = F.sort_array(F.collect_list(F.struct(F.col("period_end"), F.col("statement"), F.col(lines))), asc=False)
    return chosen.groupBy(*keys).agg(F.to_json(each).alias("snapshot"))


def why_not_alone(rows: DataFrame, tests: dict[str, Column]) -> Column:
    """The first reason, in the order given, for which one reading doesn't stand by itself; null if it does."""
    return F.coalesce(*[F.when(F.coalesce(t, F.lit(False)), name) for name, t in tests.items()], F.lit(None).cast("string"))


def hand_check(samples: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, tbl, row, printed): the printed rows of sampled lines, their cells joined in order."""
    rows = cells.join(samples.select(*keys, "tbl", "row").distinct(), [*keys, "tbl", "row"], "left_semi").groupBy(*keys, "tbl", "row").agg(F.sort_array(F.collect_list(F.struct("col", "text"))).alias("_c"))
    return rows.select(*keys, "tbl", "row", F.array_join(F.transform("_c", lambda x: x["text"]), " | ").alias("printed"))


def run_report(companies: DataFrame, keys: list[str], statuses: list[str]) -> DataFrame:
    """(keys, filings, one column for each status, seconds): what a run did for each company."""
    return companies.groupBy(*keys).agg(F.count("*").cast("long").alias("filings"), *[F.count_if(F.col("status") == s).cast("long").alias(s) for s in statuses], F.sum("seconds").alias("seconds"))
