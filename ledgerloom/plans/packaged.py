"""Packages that are made of the tables, archived, read back and resolved."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import packages
from ..streaming import runs
from .adapters import Registry, orders

query = Registry()
QUERIES, SQL = query.queries, query.sql

#: Customers of one package.
CUSTOMERS = 50
_OPEN = '<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:iso4217="http://www.xbrl.org/2003/iso4217" xmlns:xbrldi="http://xbrl.org/2006/xbrldi" xmlns:own="http://example.org/own"><unit id="usd"><measure>iso4217:USD</measure></unit>'
_LABELS = (
    '<linkbase xmlns="http://www.xbrl.org/2003/linkbase" xmlns:xlink="http://www.w3.org/1999/xlink"><labelLink xlink:role="http://www.xbrl.org/2003/role/link">'
    '<loc xlink:label="l1" xlink:href="own.xsd#own_Revenue"/><labelArc xlink:from="l1" xlink:to="r1"/><labelArc xlink:from="l1" xlink:to="r2"/>'
    '<label xlink:label="r1" xlink:role="http://www.xbrl.org/2003/role/label" xml:lang="en">Revenue of {n}</label><label xlink:label="r2" xlink:role="http://www.xbrl.org/2003/role/label" xml:lang="fr">Revenus</label></labelLink></linkbase>'
)


def _packages(spark, sf_dir, at):
    """Revenue of each customer, year and order status as an instance beside labels and a note; one package for each 50 customers."""
    rows = orders(spark, sf_dir).groupBy("o_custkey", "fiscal_year", "o_orderstatus").agg(F.sum("amount").alias("v"))
    rows = rows.withColumn("archive", F.concat(F.floor(F.col("o_custkey") / CUSTOMERS).cast("string"), F.lit(".zip")))
    context = F.format_string(
        '<context id="c%1$d_%2$d_%3$s"><entity><identifier scheme="own">%1$d</identifier><segment><xbrldi:explicitMember dimension="own:Status">own:%3$s</xbrldi:explicitMember></segment></entity>'
        '<period><startDate>%2$d-01-01</startDate><endDate>%2$d-12-31</endDate></period></context><own:Revenue contextRef="c%1$d_%2$d_%3$s" unitRef="usd" decimals="2">%4$s</own:Revenue>',
        "o_custkey", "fiscal_year", "o_orderstatus", F.col("v").cast("string"),
    )
    instance = rows.groupBy("archive").agg(F.concat(F.lit(_OPEN), F.array_join(F.sort_array(F.collect_list(context)), ""), F.lit("</xbrl>")).alias("content")).select("archive", F.lit("report/instance.xml").alias("member"), "content")
    names = instance.select("archive", F.lit("report/labels.xml").alias("member"), F.replace(F.lit(_LABELS), F.lit("{n}"), F.regexp_extract("archive", "^[0-9]+", 0)).alias("content"))
    notes = instance.select("archive", F.lit("readme.txt").alias("member"), F.lit("no facts").alias("content"))
    packages.archived(instance.unionByName(names).unionByName(notes), at).write.format("noop").mode("overwrite").save()


@query("""SELECT CAST(floor(o_custkey / 50) AS BIGINT) || '.zip' AS archive, CAST(o_custkey AS VARCHAR) AS entity, 'own:' || o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year, 'own:Revenue' AS concept, 'USD' AS unit, 2 AS decimals,
CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value, 'Revenue of ' || CAST(floor(o_custkey / 50) AS BIGINT) AS label FROM orders GROUP BY o_custkey, o_orderstatus, year(o_orderdate)""")
def package_facts(spark, sf_dir):
    """Zip packages written by tasks, read member by member, contexts, units, facts and labels joined."""
    at = runs.folder(spark, "packages")
    _packages(spark, sf_dir, at)
    rows = runs.written(packages.parsed(packages.members(spark, at).where(F.col("member").endswith(".xml"))), runs.folder(spark, "parsed"))
    found = packages.labelled(packages.facts(rows), packages.labels(rows, "en"))
    return found.select("archive", "entity", F.element_at("dims", "own:Status").alias("status"), F.year("end").alias("fiscal_year"), "concept", "unit", "decimals", "value", "label")
