"""Numbers, labels, scales and blocks in texts and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import currency, labels, numbers
from ..operators import breakdowns
from ..sources import html
from .adapters import Registry, table

query = Registry()
QUERIES, SQL = query.queries, query.sql


_DIGITS = r"(?:^|[^\w.,])\.([0-9]+)|([0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.([0-9]+))?"


@query(rf"""WITH m AS (SELECT doc_id, text, regexp_extract(text, '{_DIGITS}', 1) AS bare, regexp_extract(text, '{_DIGITS}', 2) AS whole, regexp_extract(text, '{_DIGITS}', 3) AS frac FROM documents),
d AS (SELECT *, CASE WHEN bare <> '' THEN '.' || bare WHEN frac <> '' THEN whole || '.' || frac ELSE whole END AS digits FROM m),
x AS (SELECT *, substr(text, 1, strpos(text, digits) - 1) AS before, substr(text, strpos(text, digits) + length(digits)) AS after FROM d WHERE digits <> ''),
w AS (SELECT *, lower(regexp_extract(after, '^\s*(thousand|million|billion|trillion)s?\b', 1, 'i')) AS word, lower(regexp_extract(after, '^(bn|b|m|k)\b', 1, 'i')) AS short FROM x),
f AS (SELECT *, CASE WHEN word = 'thousand' OR word = '' AND short = 'k' THEN 1e3 WHEN word = 'million' OR word = '' AND short = 'm' THEN 1e6 WHEN word = 'billion' OR word = '' AND short IN ('bn', 'b') THEN 1e9 WHEN word = 'trillion' THEN 1e12 ELSE 1 END AS factor,
  regexp_matches(before, '[-−]\(?\s*(?:(?:[A-Z]{{0,3}}\$|[€£¥])\s*)?$') OR (contains(before, '(') AND contains(after[:3], ')')) AS negative FROM w),
v AS (SELECT doc_id, CASE WHEN negative THEN -1 ELSE 1 END * CASE WHEN factor = 1 THEN CAST(replace(digits, ',', '') AS DOUBLE) ELSE round(CAST(replace(digits, ',', '') AS DOUBLE) * factor, 6) END AS value, contains(after[:3], '%') AS percent FROM f)
SELECT m.doc_id, v.value, v.percent FROM m LEFT JOIN v USING (doc_id)""")
def parse_number(spark, sf_dir):
    """The first number of every document."""
    x = numbers.parse_number(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", x.alias("x")).select("doc_id", "x.value", "x.percent")


_PLAIN = r"regexp_replace(replace(lower(coalesce(nullif(regexp_replace({0}, '\([^)]*\)\s*$', ''), ''), {0})), '&', 'and'), '[^a-z0-9]+', '', 'g')"
_CUT = r"coalesce(nullif(regexp_replace({0}, 'segment$', ''), ''), {0})".format(_PLAIN)
_KEY = r"CASE WHEN regexp_matches(" + _CUT + r", '^(all)?others?(countries|country|regions?|areas?|products?|segments?)?(notseparatelydisclosed)?$') THEN 'other' ELSE " + _CUT + "[:100] END"


@query(f"""SELECT {_KEY.format('p_type')} AS key, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1""")
def sum_by_key(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return breakdowns.sum_by_key(p, [], "p_type", "p_retailprice").select("key", F.col("value").alias("total"), "n")


@query(f"""SELECT DISTINCT p_name, p_type, {_KEY.format("p_name || ' & ' || p_type || ' segment'")} AS key FROM part""")
def member_key(spark, sf_dir):
    label = F.concat_ws("", "p_name", F.lit(" & "), "p_type", F.lit(" segment"))
    return table(spark, sf_dir, "part").select("p_name", "p_type", labels.member_key(label).alias("key")).distinct()


@query(r"""SELECT DISTINCT p_name, p_brand, regexp_replace(lower(p_brand), '[^a-z]', '', 'g') AS letters, regexp_replace(lower(p_brand), '[^a-z0-9]+', '', 'g') AS row_key, upper(p_name[1:1]) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(split_part(p_name, ' ', 2)[1:1]) || substr(split_part(p_name, ' ', 2), 2) AS title FROM part""")
def label_keys(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_name", "p_brand").distinct()
    return p.select("p_name", "p_brand", labels.label_key(F.col("p_brand")).alias("letters"), labels.row_key(F.col("p_brand")).alias("row_key"), labels.title_case(F.col("p_name")).alias("title"))


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(text, 'License') AND NOT regexp_matches(text, '[0-9]{3}') THEN true WHEN regexp_matches(text, '[0-9]{3}') AND NOT regexp_matches(text, 'License') THEN false END AS licensed FROM documents""")
def classify_docs(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", labels.classify(t.rlike("License"), t.rlike("[0-9]{3}")).alias("licensed"))


@query("SELECT doc_id, CAST(" + " + ".join(f"CAST(regexp_matches(text, '{p}') AS INTEGER)" for p in currency.DECLARED.values()) + " AS INTEGER) AS named FROM documents")
def currency_in_text(spark, sf_dir):
    """How many currencies each document names."""
    return table(spark, sf_dir, "documents").select("doc_id", F.size(currency.currencies(F.col("text"))).alias("named"))


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderpriority LIKE '1%' THEN 1000 WHEN o_orderstatus = 'P' THEN 1000000 ELSE 1 END AS DOUBLE) AS factor, CASE WHEN o_orderpriority LIKE '1%' THEN 'row' WHEN o_orderstatus = 'P' THEN 'table' ELSE 'document' END AS source FROM orders""")
def scale_cascade(spark, sf_dir):
    from ..functions.rounding import scale_cascade as cascade

    x = cascade(("row", F.when(F.col("o_orderpriority").startswith("1"), 1e3)), ("table", F.when(F.col("o_orderstatus") == "P", 1e6)), ("document", F.lit(1.0)))
    return table(spark, sf_dir, "orders").select("o_orderkey", x.alias("x")).select("o_orderkey", "x.factor", "x.source")


@query(r"""WITH r AS (SELECT o_orderkey, round(o_totalprice / 100) * 100 AS coarse, round(o_totalprice) AS fine FROM orders),
u AS (SELECT *, CASE WHEN fine = 0 THEN 1.0 ELSE pow(10.0, len(regexp_extract(CAST(CAST(fine AS BIGINT) AS VARCHAR), '(0*)$', 1))) END AS fu, CASE WHEN coarse = 0 THEN 1.0 ELSE pow(10.0, len(regexp_extract(CAST(CAST(coarse AS BIGINT) AS VARCHAR), '(0*)$', 1))) END AS cu FROM r)
SELECT o_orderkey, fu AS fine_unit, cu AS coarse_unit, abs(fine - coarse) <= greatest(fu, cu, 1.0) AS agrees, fu < cu AND abs(fine - coarse) <= cu / 2 AS refines FROM u""")
def rounding_tests(spark, sf_dir):
    from ..functions import rounding

    r = table(spark, sf_dir, "orders").select("o_orderkey", (F.round(F.col("o_totalprice") / 100, 0) * 100).alias("c"), F.round("o_totalprice", 0).alias("f"))
    f, c = F.col("f"), F.col("c")
    return r.select("o_orderkey", rounding.rounding_unit(f).alias("fine_unit"), rounding.rounding_unit(c).alias("coarse_unit"), rounding.agree(f, c).alias("agrees"), rounding.refines(f, c).alias("refines"))


@query(r"""SELECT page_id, nullif(trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's')), '') AS title FROM pages""")
def page_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.title().alias("title"))


def page_text(spark, sf_dir):
    """Text blocks and tables of every page in order; tested against literal documents."""
    found = html.items(table(spark, sf_dir, "pages"), "page_id", "html")
    return found.select("page_id", "ordinal", "kind", "tag", F.coalesce("text", F.to_json("rows")).alias("content"))


QUERIES["page_text"] = page_text


@query(r"""WITH b AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS block, CAST(length(t) AS INTEGER) AS size, CAST(coalesce(sum(length(t)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 2000 AS INTEGER) AS section FROM b WHERE trim(t) <> ''""")
def doc_blocks(spark, sf_dir):
    """Lines of each document with the section, of about 2,000 characters, that each begins in."""
    from pyspark.sql import Window

    b = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("block", "t")).where("trim(t) <> ''")
    w = Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("t")
    return b.select("doc_id", "block", size.alias("size"), F.floor(F.coalesce(F.sum(size).over(w), F.lit(0)) / 2000).cast("int").alias("section"))


@query(r"""SELECT DISTINCT source, regexp_replace(lower(source), '[0-9]+', '', 'g') AS template FROM documents""")
def source_template(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("source", labels.source_template(F.col("source")).alias("template")).distinct()


@query(r"""SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events""")
def json_props(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k BIGINT")["k"].alias("k"))
