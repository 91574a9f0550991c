"""Currencies that marks, headings and declarations name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a declaration names a currency, and marks of a value, the first that fits counts.
DECLARED = {
    "TWD": r"(?i)new taiwan dollars?|\bNT\$|\bNTD\b", "EUR": r"(?i)\beuros?\b|€", "CNY": r"(?i)\brenminbi\b|\bRMB\b", "JPY": r"(?i)\bjapanese yen\b|¥",
    "HKD": r"(?i)hong kong dollars?|\bHK\$", "GBP": r"(?i)pounds? sterling|£", "USD": r"(?i)\bU\.?S\.? dollars?\b|\bUS\$|\bUSD\b",
    "PEN": r"(?i:\bsoles\b)|\bPEN\b", "BRL": r"(?i:\breais\b|\bbrazilian reals?\b)|\bR\$|\bBRL\b",
}
MARKS = {"NT$": "TWD", "US$": "USD", "HK$": "HKD", "C$": "CAD", "A$": "AUD", "RMB": "CNY", "€": "EUR", "£": "GBP", "¥": "JPY", "S/": "PEN", "R$": "BRL"}
SCALE_PHRASE = r"(?:\b(?:in|amounts in)\s+|\(\s*(?:in\s+)?)(?:[A-Z]{0,3}\$\s*|NT\$\s*|US\$\s*)?(?:in\s+)?(?:thousands|millions|billions|mn|mm|bn)\b"
DOLLARS, PESOS = ("USD", "CAD", "AUD", "HKD", "SGD", "TWD"), ("MXN", "CLP", "ARS", "COP")


def currencies(text: Column) -> Column:
    """Codes of the currencies a text names, in the order it first names them."""
    at = [F.struct(F.regexp_instr(text, F.lit(p)).alias("at"), F.lit(code).alias("code")) for code, p in DECLARED.items()]
    return F.transform(F.array_sort(F.filter(F.array(*at), lambda x: x["at"] > 0)), lambda x: x["code"])


def declared_currency(text: Column) -> Column:
    """The one currency that the words around a scale phrase name: up to 40 characters before it in its clause, 60 after it; null for none or several."""
    pattern = F.lit(rf"(?si)(.{{0,40}}?){SCALE_PHRASE}(?=(.{{0,60}}))")
    around, after = (F.regexp_extract_all(text, pattern, F.lit(i)) for i in (0, 2))
    clause = F.transform(around, lambda a: F.regexp_replace(a, r"(?s)^.*[.;:]\s", ""))
    windows = F.zip_with(clause, after, lambda a, b: F.concat(a, b))
    named = F.array_distinct(F.flatten(F.transform(windows, currencies)))
    return F.when(F.size(named) == 1, F.get(named, 0))


def marked_currency(text: Column) -> Column:
    """The currency of a mark other than a bare `$`, null without one."""
    return F.coalesce(*[F.when(text.contains(mark), code) for mark, code in MARKS.items()])


def value_currency(text: Column, context: Column, default: Column, unit: Column) -> Column:
    """A value's currency: its own mark, what its table declares, a bare `$` as the default or else USD, then the default.

    Ratios have a currency only by mark, declaration or `$`; other units have none.
    """
    found = F.coalesce(marked_currency(text), declared_currency(context), F.when(text.contains("$"), F.coalesce(default, F.lit("USD"))), F.when(unit == "currency", default))
    return F.when(unit.isin("currency", "ratio"), found)


def bare_currency(text: Column) -> Column:
    """`$` or `pesos` where a text names a currency's kind only."""
    # How a text names dollars and pesos without a country.
    dollars = r"(?i)\(\s*\$|\$\s*(?:in\s+)?(?:millions?|thousands?|billions?|000)\b|\b(?:millions?|thousands?|billions?)\s+of\s+dollars\b|\bin\s+dollars\b"
    return F.when(text.rlike(dollars), "$").when(text.rlike(r"(?i)\b(?:millions?|thousands?|billions?)\s+of\s+pesos\b|\bin\s+pesos\b"), "pesos")
