"""What labels and sentences say, over names of parts and sentences made of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import currency, labels, scales
from .adapters import Registry, dealt, table

query = Registry()
QUERIES, SQL = query.queries, query.sql

_KEY = "regexp_replace(lower({}), '[^a-z0-9]+', '', 'g')"


@query(f"""SELECT p_partkey, substr('r' || p_partkey || {_KEY.format("p_name")}, 1, 48) AS row_key, regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g') || '_' || p_size AS checked_key, regexp_replace(lower(p_name), '[^a-z]', '', 'g') AS label_key,
{_KEY.format("p_name")} || 'gl' AS sideless, CAST(p_size AS VARCHAR) || 'nm' AS identity, p_name AS without_footnote, p_name AS row_label, p_partkey % 4 = 0 AS residual, CASE p_partkey % 3 WHEN 0 THEN 'per_share' WHEN 1 THEN 'share_count' ELSE 'amount' END AS kind FROM part""")
def keyed_labels(spark, sf_dir):
    """Names and types of parts as rows' labels: keys, footnotes, sides, kinds."""
    k, name = F.col("p_partkey"), F.col("p_name")
    with_side = F.concat(name, F.when(k % 2 == 0, " Gains").otherwise(" losses"), F.when(k % 3 == 0, " (gains)").otherwise(""))
    kind = F.when(k % 3 == 0, F.concat(name, F.lit(" per common share"))).when(k % 3 == 1, F.concat(name, F.lit(" Shares outstanding"))).otherwise(name)
    residual = F.when(k % 4 == 0, F.get(F.array(*map(F.lit, ("All other", "Other (1)", "other"))), (k % 3).cast("int"))).otherwise(F.concat(F.lit("Other "), name))
    return table(spark, sf_dir, "part").select(
        "p_partkey", labels.row_key(F.concat(k.cast("string"), F.lit(" "), name, F.lit(" (a)"))).alias("row_key"), labels.checked_key(F.concat(F.lit(" "), "p_type", F.lit(" - "), F.col("p_size").cast("string"), F.lit("!"))).alias("checked_key"), labels.label_key(F.concat(name, F.lit(" 12"))).alias("label_key"),
        labels.sideless_key(with_side).alias("sideless"), labels.identity(F.when(k % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit(" nanometers"))).otherwise(F.concat(F.lit("NM_"), F.col("p_size").cast("string")))).alias("identity"),
        labels.without_footnote(F.concat(name, F.when(k % 2 == 0, " (b)").otherwise(" (12)"))).alias("without_footnote"), labels.row_label(F.concat(name, F.when(k % 2 == 0, "7").otherwise(" (c)"))).alias("row_label"), labels.is_residual(residual).alias("residual"), labels.line_kind(kind).alias("kind"),
    )


_TITLED = "list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:])"


@query(f"""WITH t AS (SELECT p_partkey, p_name, {_TITLED} AS w FROM part)
SELECT p_partkey, array_to_string(w, ' ') AS humanized, array_to_string(w, '') || 'Axis' AS axis, array_to_string(list_transform(w, lambda x: x[1]), '') AS initials, array_to_string(w, ' ') AS titled, true AS named, len(w) >= 2 AS by_initials,
'# ' || lower(p_name) || ' in @ # and @' AS template, CASE WHEN length(p_name) <= 8 THEN p_name WHEN instr(substr(p_name, 1, 9), ' ') > 0 THEN regexp_extract(substr(p_name, 1, 9), '^(.*) ', 1) ELSE substr(p_name, 1, 8) END AS fitted FROM t""")
def readable_labels(spark, sf_dir):
    """Names of parts as tags, titles and sentences, made readable again."""
    name = F.col("p_name")
    camel = F.array_join(F.transform(F.split(name, " "), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, F.lit(2), F.length(w)))), "")
    titled = labels.title_case(name)
    sentence = F.concat(F.lit("12,345.6 "), name, F.lit("  in March 2021 and Q3"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", labels.humanize(F.concat(F.lit("own:"), camel, F.lit("SegmentMember"))).alias("humanized"), labels.axis_name(F.concat(F.lit("dim_own_"), camel, F.lit("Axis"))).alias("axis"), labels.initials(F.concat(titled, F.lit(" of the"))).alias("initials"), titled.alias("titled"),
        labels.names_segment(F.concat(F.lit("Results of "), titled), name).alias("named"), labels.names_segment(F.concat(labels.initials(titled), F.lit(" results")), titled).alias("by_initials"), labels.quote_template(sentence).alias("template"), labels.fit_label(name, 8).alias("fitted"),
    )


@query("""WITH p AS (SELECT p_partkey, p_name, regexp_extract_all(lower(p_name), '[a-z0-9]+') AS w FROM part), n AS (SELECT p.*, q.p_name AS other, q.w AS v FROM p JOIN p q ON q.p_partkey = p.p_partkey + 1),
c AS (SELECT *, array_to_string(w, '') AS a, array_to_string(v, '') AS b, len(list_intersect(list_distinct(w), v)) AS common FROM n)
SELECT p_partkey, contains(a, b) OR contains(b, a) OR common >= 0.5 * least(len(list_distinct(w)), len(list_distinct(v))) AS agree, p_partkey % 3 < 2 AS combined, CASE WHEN a <> b THEN 'k1' END AS listed, 'k2' AS tail FROM c""")
def matched_labels(spark, sf_dir):
    """Neighbouring parts' names against each other, as subtotals, and among the items of a list."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    both = dealt(p.join(p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("other")), "p_partkey"))
    k, name, other = F.col("p_partkey"), F.col("p_name"), F.col("other")
    item = lambda key, label: F.struct(F.lit(key).alias("key"), label.alias("label"))
    long = F.concat(F.lit("revenue from "), name)
    return both.select(
        "p_partkey", labels.labels_agree(name, other).alias("agree"), labels.combined_line(F.when(k % 3 == 0, F.concat(other, F.lit(" and "), name)).when(k % 3 == 1, F.concat(F.lit("Total "), name)).otherwise(F.concat(F.lit("our "), name)), name).alias("combined"),
        labels.listed_item(F.concat(F.upper(name), F.lit(" 7")), F.array(item("k1", name), item("k3", other)))["key"].alias("listed"),
        labels.listed_item(F.concat(F.lit("net "), long), F.array(item("k2", long)))["key"].alias("tail"),
    )


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS t FROM orders WHERE o_totalprice >= 1)
SELECT k, 'Orders of year' AS label, 3 AS slots, CAST(k % 3 AS INTEGER) AS at, 'of the customer' AS anchors, k % 2 = 0 AS forward, k % 2 = 1 AS falls, CASE k % 3 WHEN 0 THEN 'net' WHEN 1 THEN 'gross' END AS mismatch, k % 2 = 0 AS part FROM o""")
def quoted_sentences(spark, sf_dir):
    """Order totals in quoted rows and sentences: which figure of a row, which words before it, what the sentence says of it."""
    k, t = F.col("o_orderkey"), F.floor("o_totalprice")
    text = F.format_number(t, 0)
    fill = lambda i: F.when(k % 3 == i, F.concat(F.lit("$ "), text)).otherwise(F.lit(f"({i}.5)%"))
    line = labels.row_line(F.concat(F.lit("Orders  of year12 "), fill(0), F.lit(" "), fill(1), F.lit(" "), fill(2)), text)
    forward = F.when(k % 2 == 0, F.get(F.array(*map(F.lit, ("We now expect more", "our outlook is good", "It will be less"))), (k % 3).cast("int"))).otherwise("expected to be recognized, as we said")
    falls = F.when(k % 2 == 1, F.concat(F.lit("orders decreased sharply by "), text)).otherwise(F.concat(F.lit("orders declined to "), text))
    word = F.get(F.array(*map(F.lit, ("Net sales", "gross sales", "sales"))), (k % 3).cast("int"))
    label = F.get(F.array(*map(F.lit, ("Gross sales", "Net sales", "Net sales"))), (k % 3).cast("int"))
    part = F.when(k % 2 == 0, F.when(k % 4 == 0, "All other sale").otherwise("Other sales")).otherwise("Other income")
    return table(spark, sf_dir, "orders").where("o_totalprice >= 1").select(
        k.alias("k"), line["label"].alias("label"), F.size(line["slots"]).alias("slots"), line["index"].alias("at"), F.array_join(labels.anchor_words(F.concat(F.lit("Sum of the Customer: "), text, F.lit(" in all")), text, 3), " ").alias("anchors"),
        labels.forward_looking(forward).alias("forward"), labels.falls(falls, text).alias("falls"), labels.net_gross_mismatch(word, label).alias("mismatch"), labels.part_row(part, F.lit("Sale")).alias("part"),
    )


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS t FROM orders WHERE o_totalprice >= 1)
SELECT k, ['EUR', 'TWD', 'USD', NULL][k % 4 + 1] AS declared, ['EUR', 'TWD', 'CAD'][k % 3 + 1] AS of_value, CASE k % 3 WHEN 0 THEN 'EUR,USD' WHEN 1 THEN 'EUR,GBP' ELSE '' END AS named, ['$', 'pesos', NULL][k % 3 + 1] AS bare,
[1e6, 1e3, NULL][k % 3 + 1] AS money, [1e3, 1e3, 1.0][k % 3 + 1] AS shares, CASE WHEN k % 5 = 0 THEN NULL ELSE power(10.0, 3 * (k % 3)) END AS proven FROM o""")
def money_texts(spark, sf_dir):
    """Captions and cells made of orders: the currency they declare, name or leave bare, and the scale that they state or that values prove."""
    k, t = F.col("o_orderkey"), F.floor("o_totalprice").cast("double")
    pick = lambda n, *texts: F.get(F.array(*[F.lit(x) for x in texts]), (k % n).cast("int"))
    declared = pick(4, "(€, in millions)", "in thousands of New Taiwan dollars", "(in millions of U.S. dollars)", "(in millions of euros and Japanese yen)")
    text = F.format_number(t, 0)
    value = F.when(k % 3 == 1, F.concat(F.lit("NT$"), text)).otherwise(text)
    context = F.when(k % 3 == 0, "(€, in millions)").otherwise("")
    named = pick(3, "paid in US dollars and in euros", "£7 or €9", "nothing of it")
    bare = pick(3, "($ millions)", "(in thousands of pesos)", "in millions")
    caption = pick(3, "(in millions, except shares in thousands)", "(in thousands)", "Orders of the year")
    scale = scales.statement_scale(caption)
    factor = F.pow(F.lit(10.0), 3 * (k % 3))
    proof = scales.proven_scale(F.array(t, t + 1, t + 2), F.when(k % 5 == 0, F.array(t * 3.3, t * 4.7, t * 5.9)).otherwise(F.array(t * factor, (t + 1) * factor, F.lit(None).cast("double"))))
    return table(spark, sf_dir, "orders").where("o_totalprice >= 1").select(
        k.alias("k"), currency.declared_currency(declared).alias("declared"), currency.value_currency(value, context, F.lit("CAD"), F.lit("currency")).alias("of_value"), F.array_join(F.array_sort(currency.currencies(named)), ",").alias("named"), currency.bare_currency(bare).alias("bare"),
        scale["money"].cast("double").alias("money"), scale["shares"].cast("double").alias("shares"), proof.cast("double").alias("proven"),
    )
