"""Numbers as they are printed: signs, brackets, percent signs and scale words. Digits are ASCII ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scale words and abbreviations.
FACTORS = {"thousand": 1e3, "million": 1e6, "billion": 1e9, "trillion": 1e12}
ABBREVIATIONS = {"bn": "billion", "b": "billion", "m": "million", "k": "thousand"}
#: The digits of a number, or of a bare fraction that neither a word nor a number precedes.
DIGITS = r"(?<![\w.,])\.[0-9]++|(?:[0-9]{1,3}(?:,[0-9]{3})++|[0-9]++)(?:\.[0-9]++)?+"
#: A minus before a number: a bracket and a currency mark may stand between. Repeats never give back, so blanks cost no more than their length.
MINUS = r"[-−]\(?+\s*+(?:(?:[A-Z]{0,3}+\$|[€£¥])\s*+)?+$"
SCALE_AFTER = r"(?i)^(?:\s*+(?:(thousand|million|billion|trillion)s?+\b)|(bn|b|m|k)\b)"
_ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
_TENS = {"thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90}


def clean(text: Column) -> Column:
    """Non-breaking spaces and runs of white space become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, " ", " "), r"\s+", " "))


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parse_number(text: Column) -> Column:
    """struct(value, percent, scale_word) of the first number in a text, null without one.

    A minus before it, or a bracket before and one after it, makes it negative; a scale word or abbreviation after it is
    applied (`$3.6B` is 3,600,000,000) and given. `.51` counts unless a letter, digit, dot or comma precedes it.
    """

    def around(at: Column) -> Column:
        digits = F.regexp_extract(text, DIGITS, 0)
        return F.struct(F.substring(text, F.lit(1), at - 1).alias("before"), digits.alias("digits"), F.substring(text, at + F.length(digits), F.length(text)).alias("after"))

    def number(x: Column) -> Column:
        word = F.lower(F.regexp_extract(x["after"], SCALE_AFTER, 1))
        short = F.lower(F.regexp_extract(x["after"], SCALE_AFTER, 2))
        word = F.when(word != "", word).otherwise(_map(ABBREVIATIONS)[short])
        size = F.regexp_replace(x["digits"], ",", "").cast("double")
        size = F.when(word.isNull(), size).otherwise(F.round(size * _map(FACTORS)[word], 6))
        near = F.substring(x["after"], 1, 3)
        negative = x["before"].rlike(MINUS) | (x["before"].contains("(") & near.contains(")"))
        return F.struct(F.when(negative, -size).otherwise(size).alias("value"), near.contains("%").alias("percent"), word.alias("scale_word"))

    return let(F.nullif(F.regexp_instr(text, F.lit(DIGITS)), F.lit(0)), lambda at: F.when(at.isNotNull(), let(around(at), number)))


def statement_number(text: Column, once: bool = False) -> Column:
    """A cell of a statement: 1,234, (1,234) or a dash for nothing, which is 0; null for captions and prose. once: within a lambda, where Spark would clean the text anew for each test of it."""
    t = F.regexp_replace(clean(text), r"[$€£¥\s]", "")
    return let(t, _statement) if once else _statement(t)


def _statement(t: Column) -> Column:
    plain = F.regexp_replace(t, r"[(),]", "").try_cast("double")
    return F.when(t.rlike(r"^[-–—]+$"), F.lit(0.0)).when(t.rlike(r"^\([0-9][0-9,]*(\.[0-9]+)?\)$"), -plain).when(t.rlike(r"^-?[0-9][0-9,]*(\.[0-9]+)?$"), plain)


def word_number(text: Column) -> Column:
    """struct(value, percent, scale_word) of the first count spelled out: `nine countries`, `twenty-five`, `two billion`; null without one."""
    ones = "|".join(_ONES[:10])
    pattern = rf"(?i)\b({'|'.join([*_ONES, *_TENS])})\b(?:[- ]({ones})\b)?(?:\s*(thousand|million|billion|trillion)s?\b)?"
    values = _map({w: float(i) for i, w in enumerate(_ONES)} | {w: float(n) for w, n in _TENS.items()})
    part = lambda i: F.nullif(F.lower(F.regexp_extract(text, pattern, i)), F.lit(""))
    size = values[part(1)] + F.coalesce(values[part(2)], F.lit(0.0))
    found = F.struct(F.round(size * F.coalesce(_map(FACTORS)[part(3)], F.lit(1.0)), 6).alias("value"), F.lit(False).alias("percent"), part(3).alias("scale_word"))
    return F.when(part(1).isNotNull(), found)


def figure_forms(value: Column) -> Column:
    """How a figure may be written, whatever the scale word: 12,000,000,000 as 12, 12.0 or 12,000; distinct, in order."""
    forms = []
    for scale in (1, 1e3, 1e6, 1e9, 1e12):
        scaled = F.abs(value) / F.lit(float(scale))
        forms += [F.when((scaled >= 1) & (F.abs(F.round(scaled, d) - scaled) < 1e-9), F.format_number(scaled, d)) for d in (0, 1, 2)]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*forms))))


def decimals(text: Column) -> Column:
    """Printed decimal places of a number's text."""
    return F.length(F.regexp_extract(text, r"\.([0-9]+)", 1)).cast("int")


def fifteen_digits(value: Column) -> Column:
    """The value to 15 significant digits, which takes binary noise off."""
    return F.format_string("%.14e", value).cast("double")
