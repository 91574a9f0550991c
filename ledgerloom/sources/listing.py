"""Which of a company's filings are read, from tables of filings and attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fiscal import ANNUAL_FORMS, fiscal_year_end_for, quarter_end_before, release_period
from ..operators.joins import newest_per_key

# Forms, days after a quarter's end in which results come, days of a recent listing and before its first report.
REPORT_FORMS = ("10-K", "10-K405", "10-KT", "10-KSB", "10-Q", "20-F", "40-F")
PROSPECTUS_FORMS, PRINTED_DOCUMENTS = ("424B4", "424B1"), ("10-K", "10-K405", "10-Q", "20-F", "40-F", "10-KT", "EX-13")
RELEASE_DAYS, CANDIDATE_DAYS, RECENT, BEFORE = (5, 100), (5, 75), 730, 400
PAPER = "9999999997-"


def allowed_url(url: Column, prefixes: list[str]) -> Column:
    """Whether a stored address is one of a source's."""
    return F.coalesce(*[F.when(url.startswith(p), True) for p in prefixes], F.lit(False))


def period_ends(filings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ends): the distinct periods that a company's reports cover, in order."""
    return filings.where(F.col("report_date").isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_set("report_date")).alias("ends"))


def all_reports(filings: DataFrame, successors: DataFrame, company: str) -> DataFrame:
    """Periodic reports of companies and, before the successor's first filing of any form, of their predecessors.

    successors: predecessor, company. Amendments have other forms and fall out.
    """
    own = filings.where(F.col("form").isin(*REPORT_FORMS))
    first = filings.groupBy(company).agg(F.min("filed").alias("_first"))
    earlier = filings.where(F.col("form").isin(*REPORT_FORMS)).withColumnRenamed(company, "predecessor").join(successors, "predecessor").join(first, company).where("filed < _first")
    return own.unionByName(earlier.select(*own.columns))


def tagged_interims(filings: DataFrame) -> DataFrame:
    """Furnished filings, amendments too, that carry tagged facts, as one form."""
    return filings.where(F.col("form").isin("6-K", "6-K/A") & F.col("is_xbrl")).withColumn("form", F.lit("6-K"))


def releases(filings: DataFrame, profiles: DataFrame, company: str) -> DataFrame:
    """Furnished filings within the release window after a quarter's end, with that end; filings made on paper have no documents.

    profiles: company, mmdd.
    """
    own = filings.where((F.col("form") == "6-K") & ~F.col("accession").startswith(PAPER)).join(profiles.select(company, "mmdd"), company)
    end = quarter_end_before(F.col("filed"), F.col("mmdd"))
    return own.withColumn("quarter_end", end).where(F.date_diff("filed", "quarter_end").between(*RELEASE_DAYS)).drop("mmdd")


def earnings_candidates(filings: DataFrame, profiles: DataFrame, company: str) -> DataFrame:
    """Filings that are or may be results, with `quarter_end` and `confirmed`.

    A home filer's 8-K of item 2.02 is confirmed; others within 75 days of a quarter's end are candidates where the quarter
    has no confirmed one; a foreign filer's 6-K always is one. profiles: company, mmdd, is_foreign, ends (own quarter ends).
    """
    own = filings.join(profiles, company).where(F.col("form") == F.when(F.col("is_foreign"), "6-K").otherwise("8-K"))
    ends = F.when(~F.col("is_foreign"), F.col("ends"))
    before = quarter_end_before(F.col("filed"), F.col("mmdd"), ends)
    confirmed = ~F.col("is_foreign") & F.coalesce(F.col("items").contains("2.02"), F.lit(False))
    rows = own.withColumn("_gap", F.date_diff("filed", before)).withColumn("quarter_end", release_period(F.col("filed"), F.col("mmdd"), ends)).withColumn("confirmed", confirmed)
    rows = rows.where(F.col("confirmed") | F.col("_gap").between(*CANDIDATE_DAYS))
    has = F.bool_or("confirmed").over(Window.partitionBy(company, "quarter_end"))
    return rows.withColumn("_has", has).where(F.col("confirmed") | F.col("is_foreign") | ~F.col("_has")).select(*filings.columns, "quarter_end", "confirmed")


def prospectus(filings: DataFrame, first_reports: DataFrame, company: str, today: Column) -> DataFrame:
    """The newest final prospectus of each recent listing, up to 400 days before its first report.

    first_reports: company, first_report; a listing is recent if that is at most two years old.
    """
    recent = first_reports.where(F.col("first_report") >= F.date_sub(today, RECENT))
    near = filings.where(F.col("form").isin(*PROSPECTUS_FORMS)).join(recent, company).where(F.col("filed").between(F.date_sub("first_report", BEFORE), F.col("first_report")))
    return newest_per_key(near, [company], [F.desc("filed"), F.desc("accession")]).select(*filings.columns)


def first_year(filings: DataFrame, company: str, since: Column) -> DataFrame:
    """Filings since a day, and the earlier quarterly ones of the fiscal year that the first of them covers.

    filings: company, form, filed, mmdd (null where unknown: nothing is added) and period_end (null: the quarter end before filing).
    """
    period = F.coalesce("period_end", quarter_end_before(F.col("filed"), F.col("mmdd")))
    rows = filings.withColumn("_end", fiscal_year_end_for(period, F.col("mmdd")))
    inside = F.col("filed") >= since
    first = F.min_by(F.when(inside, F.col("_end")), F.when(inside, F.col("filed"))).over(Window.partitionBy(company))
    rows = rows.withColumn("_first", first)
    added = (F.col("_end") == F.col("_first")) & ~F.col("form").isin(*ANNUAL_FORMS)
    return rows.where(inside | F.coalesce(added, F.lit(False))).drop("_end", "_first")


def printed_documents(attachments: DataFrame) -> DataFrame:
    """The attachments of a report that hold its printed statements: the report itself and an annual report's exhibit."""
    return attachments.where(F.upper("document_type").isin(*PRINTED_DOCUMENTS))


def release_documents(attachments: DataFrame, filing: str, order: str) -> DataFrame:
    """A release's furnished exhibits; of one without any the first 6-K document and its numbered exhibits, contracts (EX-10) left out."""
    kind = F.upper("document_type")
    rows = attachments.withColumns({"_k": kind, "_ex": F.bool_or(kind.startswith("EX-99")).over(Window.partitionBy(filing))})
    first = F.min(F.when(F.col("_k") == "6-K", F.col(order))).over(Window.partitionBy(filing))
    rows = rows.withColumn("_first", first)
    other = (F.col(order) == F.col("_first")) | (F.col("_k").rlike(r"^EX-[0-9]+(\.[0-9]+)?$") & ~F.col("_k").startswith("EX-10"))
    return rows.where(F.when(F.col("_ex"), F.col("_k").startswith("EX-99")).otherwise(other)).drop("_k", "_ex", "_first")


def fresh_lists(lists: DataFrame, company: str, taken: str, now: Column, minutes: int = 90) -> DataFrame:
    """The newest kept copy of each company's filing list, if it isn't older than so many minutes; older parts (column `part`) are all kept."""
    newest = newest_per_key(lists.where("part IS NULL"), [company], [F.desc(taken)])
    return newest.where(F.col(taken) >= now - F.make_dt_interval(mins=F.lit(minutes))).unionByName(lists.where("part IS NOT NULL"))


def role_order(arcs: DataFrame, role: str) -> DataFrame:
    """(role, element, depth, position): a role's elements in the order of a walk down its arcs, each parent's children by their order.

    arcs: role, parent, child, order. Each level is a join; a path of orders gives the position.
    """
    from ..operators.joins import cut

    tops = arcs.select(role, F.col("parent").alias("element")).distinct().join(arcs.select(role, F.col("child").alias("element")).distinct(), [role, "element"], "left_anti")
    step = cut(tops.select(role, "element", F.lit(0).alias("depth"), F.array(F.struct(F.lit(0.0).alias("o"), F.col("element").alias("e"))).alias("path")))
    out, down = step, arcs.select(role, F.col("parent").alias("_p"), F.col("child").alias("_c"), F.col("order").cast("double").alias("_o"))
    d = 0
    while not step.isEmpty():
        if not step.where(F.size(F.array_distinct(F.transform("path", lambda x: x["e"]))) < F.size("path")).isEmpty():
            raise ValueError("arcs lead in a circle")
        d += 1
        step = step.withColumnRenamed("element", "_p").join(down, [role, "_p"])
        step = cut(step.select(role, F.col("_c").alias("element"), F.lit(d).alias("depth"), F.concat("path", F.array(F.struct(F.col("_o").alias("o"), F.col("_c").alias("e")))).alias("path")))
        out = out.union(step)
    w = Window.partitionBy(role).orderBy("path")
    return out.select(role, "element", "depth", F.row_number().over(w).alias("position"))
