"""Which of several presentations counts, what others say of it, and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import newest_per_key


def choose(df: DataFrame, keys: list[str], good: Column, rank: Column, newest: list[Column]) -> DataFrame:
    """Of each key the presentation that holds, then of the best rank, then the newest."""
    return newest_per_key(df.withColumn("_good", good.cast("int")).withColumn("_rank", rank), keys, [F.desc("_good"), F.col("_rank"), *newest]).drop("_good", "_rank")


def witnesses(df: DataFrame, keys: list[str], order: list[Column], value: str, filed: str, tolerance: float = 0.0) -> DataFrame:
    """(keys, value, witness) of the presentation that comes first in an order that ends in a unique column.

    single: no other presents the value; confirmed: another one agrees, within a share of it; restated: none agrees and
    all others were filed no later than it; contradicted: a later one differs.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.select(*keys, value, filed, F.row_number().over(w).alias("_n"), F.first(F.struct(F.col(value).alias("v"), F.col(filed).alias("f"))).over(w).alias("_won"))
    other = F.col("_n") > 1
    near = F.abs(F.col(value) - F.col("_won.v")) <= tolerance * F.abs("_won.v")
    agg = ranked.groupBy(*keys).agg(
        F.first("_won.v").alias(value), F.count_if(other).alias("_others"), F.coalesce(F.bool_or(F.when(other, near)), F.lit(False)).alias("_agrees"),
        F.coalesce(F.bool_and(F.when(other, F.col(filed) <= F.col("_won.f"))), F.lit(True)).alias("_earlier"),
    )
    verdict = F.when(F.col("_others") == 0, "single").when(F.col("_agrees"), "confirmed").when(F.col("_earlier"), "restated").otherwise("contradicted")
    return agg.select(*keys, value, verdict.alias("witness"))


def mixed_vintage(chosen: DataFrame, keys: list[str], period: str, restated: str) -> DataFrame:
    """(keys): years of which one of the year (FY) and its nine months (9M) was restated and the other wasn't.

    A fourth quarter worked out from the two would mix their presentations; a year without nine months isn't one.
    """
    of = lambda p: F.bool_or(F.when(F.col(period) == p, F.col(restated)))
    both = chosen.groupBy(*keys).agg(of("FY").alias("_y"), of("9M").alias("_n"))
    return both.where("_y <> _n").select(*keys)


def differences(later: DataFrame, earlier: DataFrame, keys: list[str], value: str, tolerance: float = 1e-6) -> DataFrame:
    """(keys, later, earlier, change): added, removed, sign or changed; equal rows are left out."""
    both = later.select(*keys, F.col(value).alias("later")).join(earlier.select(*keys, F.col(value).alias("earlier")), keys, "full")
    a, b = F.col("later"), F.col("earlier")
    near = lambda x, y: F.abs(x - y) <= F.greatest(F.abs(x), F.abs(y)) * tolerance
    change = F.when(b.isNull(), "added").when(a.isNull(), "removed").when(near(a, b), None).when(near(a, -b), "sign").otherwise("changed")
    return both.withColumn("change", change).where("change IS NOT NULL")


def sign_vote(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, sign): the sign of most values, 0 for a tie."""
    return df.groupBy(*keys).agg(F.signum(F.sum(F.signum(value))).cast("int").alias("sign"))


def split_factor(df: DataFrame, splits: DataFrame, key: str, day: str) -> DataFrame:
    """Rows with `factor`, the product of the ratios of all splits of the key after the row's day."""
    ledger = splits.groupBy(key).agg(F.collect_list(F.struct("split_day", "ratio")).alias("_s"))  # a handful for each key
    later = F.filter(F.coalesce("_s", F.array().cast("array<struct<split_day:date,ratio:double>>")), lambda s: s["split_day"] > F.col(day))
    return df.join(ledger, key, "left").withColumn("factor", F.aggregate(later, F.lit(1.0), lambda a, s: a * s["ratio"])).drop("_s")


def source_rank(form: Column, source: Column, annual: Column) -> Column:
    """0 for a filed report, an annual one where the year is meant, 1 for other reports, 2 for a regulator's, 3 for a release."""
    report = form.rlike("^(?:10-K|10-Q|20-F|40-F)")
    yearly = form.rlike("^(?:10-K|20-F|40-F)")
    return F.when(source == "regulator", 2).when(report & (~annual | yearly), 0).when(report, 1).otherwise(3)


def other_bases(kept: DataFrame, winners: DataFrame, keys: list[str], basis: str, scope: str, filed: list[Column]) -> DataFrame:
    """The newest presentation of each period on each basis but the winner's, of the winner's scope first."""
    w = winners.select(*keys, F.col(basis).alias("_basis"), F.col(scope).alias("_scope"))
    rest = kept.join(w, keys).where(F.col(basis).isNotNull() & (F.col(basis) != F.col("_basis")))
    own = rest.withColumn("_own", (F.col(scope) == F.col("_scope")).cast("int"))
    return newest_per_key(own, [*keys, basis], [F.desc("_own"), *filed]).drop("_own", "_basis", "_scope")


def per_share_scale(tagged: Column, shown: Column, decimals: Column) -> Column:
    """3 or 6 where a tagged per-share figure is the shown one times a thousand or a million, to its rounding and within a tenth of it; else 0."""
    slack = F.least(0.5 * F.pow(F.lit(10.0), -decimals) + 1e-9 * F.abs(shown), 0.1 * F.abs(shown))
    off = lambda p: F.abs(F.abs(tagged) / 10.0**p - F.abs(shown)) <= slack
    ok = (tagged != 0) & (shown != 0) & (F.signum(tagged) == F.signum(shown))
    return F.when(ok & off(3), 3).when(ok & off(6), 6).otherwise(0)


# Concepts and labels of the figures that two presentations are compared on.
KEY_FIGURES = {
    "net income": ("income", r"_(NetIncomeLoss|ProfitLoss|ProfitLossAttributableToOwnersOfParent|NetIncomeLossAvailableToCommonStockholdersBasic)$", r"(?i)^(consolidated\s+)?(net\s+(income|earnings|profit|loss)|profit\s+for\s+the)\b"),
    "revenue": ("income", r"_(Revenues|RevenueFromContractWithCustomerExcludingAssessedTax|SalesRevenueNet|Revenue)$", r"(?i)^(total\s+)?(net\s+)?(sales|revenues?|net\s+revenues?)\b|^total\s+net\s+(sales|revenues?)\b"),
    "total assets": ("balance", r"_Assets$", r"(?i)^total\s+assets\b"),
    "closing cash": ("cash_flow", r"_(CashAndCashEquivalentsAtCarryingValue|CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents|CashAndCashEquivalents|Cash)$", r"(?i)\bend\s+of\b"),
}


def key_figures(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name, value): net income (the largest), revenue and total assets (the first) and closing cash (the last) of a statement.

    lines: keys, statement, position, concept, label, value. A concept that names the figure goes before a label.
    """
    names = [F.when((F.col("statement") == s) & (F.col("concept").rlike(c) | F.col("label").rlike(p)), F.struct(F.lit(n).alias("name"), F.col("concept").rlike(c).alias("tagged"))) for n, (s, c, p) in KEY_FIGURES.items()]
    each = lines.where("value IS NOT NULL").select(*keys, "position", "value", F.explode(F.array_compact(F.array(*names))).alias("x")).select(*keys, "position", "value", "x.*")
    order = F.when(F.col("name") == "net income", -F.abs("value")).when(F.col("name") == "closing cash", -F.col("position")).otherwise(F.col("position"))
    return newest_per_key(each.withColumn("_o", order), [*keys, "name"], [F.desc("tagged"), F.col("_o"), F.col("position")]).select(*keys, "name", "value")


def summary_verdicts(rows: DataFrame, printed: DataFrame, table: str, tolerance: Column | None = None) -> DataFrame:
    """(table, verdict): a summary table's figures against statements, its own filing's where these print them, else any.

    rows: table, accession, year, name, value; printed: accession, year, name, value. contradicted if a net income or total
    assets differs, or nothing agrees; unverified without a statement; verified, or verified elsewhere.
    """
    from ..functions.rounding import agree

    p = printed.select("year", "name", F.col("accession").alias("_a"), F.col("value").alias("_v"))
    near = F.coalesce(agree(F.col("value"), F.col("_v")), F.lit(False))
    both = rows.join(p, ["year", "name"], "left")
    own = F.col("_a") == F.col("accession")
    per = both.groupBy(table, "year", "name", "value").agg(F.bool_or(own).alias("_has_own"), F.bool_or(own & near).alias("_own_ok"), F.bool_or(near).alias("_ok"), F.bool_or(F.col("_a").isNotNull()).alias("_some"))
    any_own = F.bool_or(F.coalesce("_has_own", F.lit(False))).over(Window.partitionBy(table))
    per = per.withColumn("_mode", any_own).where(F.col("_some"))
    checked = F.when(F.col("_mode"), F.when(F.coalesce("_has_own", F.lit(False)), F.coalesce("_own_ok", F.lit(False)))).otherwise(F.col("_ok"))
    anchor = F.col("name").isin("net income", "total assets")
    agg = per.withColumn("_c", checked).where("_c IS NOT NULL").groupBy(table, "_mode").agg(F.bool_or(~F.col("_c") & anchor).alias("_bad"), F.bool_or(~F.col("_c")).alias("_wrong"), F.bool_or(F.col("_c") & anchor).alias("_anchored"))
    verdict = F.when(F.col("_bad") | (F.col("_wrong") & ~F.col("_anchored")), "contradicted").when(F.col("_mode"), "verified").otherwise("verified elsewhere")
    return rows.select(table).distinct().join(agg.select(table, verdict.alias("verdict")), table, "left").withColumn("verdict", F.coalesce("verdict", F.lit("unverified")))


def years_without(figures: DataFrame, covered: DataFrame, keys: list[str], filed: list[Column]) -> DataFrame:
    """The newest summary figure of each key that no statement covers."""
    return newest_per_key(figures.join(covered.select(*keys), keys, "left_anti"), keys, filed)
