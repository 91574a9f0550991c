"""Tolerances that follow from how figures are printed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounding_unit(value: Column) -> Column:
    """The place of the last digit that isn't zero of a whole figure, a trillion at most: 12,300 is given in hundreds."""
    zeros = F.length(F.regexp_extract(F.format_string("%.0f", F.abs(value)), "(0*)$", 1))
    return F.when(F.rint(value) == 0, F.lit(1.0)).otherwise(F.least(F.pow(F.lit(10.0), zeros), F.lit(1e12)))


def places(value: Column) -> Column:
    """The decimals a figure is stated to, up to six: 3.65 has 2."""
    exact = lambda d: F.abs(value * F.pow(F.lit(10.0), d) - F.rint(value * F.pow(F.lit(10.0), d))) < 1e-6 * F.greatest(F.lit(1.0), F.abs(value) * F.pow(F.lit(10.0), d))
    return F.coalesce(F.get(F.filter(F.array(*[F.lit(d) for d in range(7)]), exact), 0), F.lit(6))


def stated_tolerance(value: Column) -> Column:
    """Half a unit of a figure's own rounding: 0.005 for 3.65; a whole figure has two significant digits at least, 0.5 at least."""
    whole = F.format_string("%.0f", F.abs(value))
    most = F.pow(F.lit(10.0), F.greatest(F.length(whole) - 2, F.lit(0)))
    step = F.when(whole == "0", F.lit(1.0)).otherwise(F.least(rounding_unit(value), most))
    n = places(value)
    return F.when(n > 0, 0.5 * F.pow(F.lit(10.0), -n)).otherwise(F.greatest(step / 2, F.lit(0.5)))


def is_evidence(fact: Column, value: Column) -> Column:
    """Whether a tagged figure speaks for a stated one: within its tolerance; a whole one of one or two digits only exactly."""
    exact = (places(value) == 0) & (F.abs(value) < 100)
    return F.when(exact, F.abs(fact - value) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(value))).otherwise(F.abs(fact - value) <= stated_tolerance(value))


def reported_tolerance(decimals: Column) -> Column:
    """Half a unit of stated decimals, 0.5 at least; null decimals are exact."""
    return F.greatest(F.lit(0.5), F.coalesce(F.pow(F.lit(10.0), -decimals) / 2, F.lit(0.5)))


def same_figure(a: Column, b: Column) -> Column:
    """Equal but for binary noise."""
    return F.abs(a - b) <= F.greatest(F.abs(a), F.abs(b)) * 1e-9


def agree(a: Column, b: Column) -> Column:
    """Within the coarser of both rounding units, 1 at least."""
    return F.abs(a - b) <= F.greatest(rounding_unit(a), rounding_unit(b), F.lit(1.0))


def refines(fine: Column, coarse: Column) -> Column:
    """Whether a figure is another one to more places."""
    unit = rounding_unit(coarse)
    return (rounding_unit(fine) < unit) & (F.abs(fine - coarse) <= unit / 2)


def same_to_zeros(a: Column, b: Column) -> Column:
    """Equal at the precision that the closing zeros of the coarser figure give."""
    unit = F.greatest(rounding_unit(a), rounding_unit(b))
    return F.abs(a - b) <= unit / 2


def printed_half(printed: Column, scale: Column) -> Column:
    """Half of the last printed place of a figure's text, in units: `3.6` at a scale of 1e9 gives 5e7."""
    decimals = F.length(F.regexp_extract(printed, r"\.([0-9]+)", 1))
    return 0.5 * F.pow(F.lit(10.0), -decimals) * scale


def printed_tolerance(terms: Column | int) -> Column:
    """Half a unit of each printed term of a sum and of its total."""
    return 0.5 * (F.lit(terms) if isinstance(terms, int) else terms)


def coarsest_step(values: Column) -> Column:
    """The largest power of ten, a billion at most, that every figure of an array is a whole multiple of."""
    fits = lambda e: F.forall(values, lambda n: F.abs(n / F.pow(F.lit(10.0), e) - F.rint(n / F.pow(F.lit(10.0), e))) <= 1e-6)
    return F.pow(F.lit(10.0), F.coalesce(F.get(F.filter(F.array(*[F.lit(e) for e in range(9, -7, -1)]), fits), 0), F.lit(-6)))


def release_unit(value: Column, cell: Column) -> Column:
    """The power of ten between a stored figure and its cell, null if their ratio is over a tenth off one."""
    unit = F.pow(F.lit(10.0), F.rint(F.log10(F.abs(value / F.nullif(cell, F.lit(0.0))))))
    return F.when((value != 0) & (F.abs(F.abs(value / cell) / unit - 1) <= 0.1), unit)


def refined_rest(parts: Column, sibling: Column, total: Column, finest: Column) -> Column:
    """What a total leaves after its parts, where that rounds to a sibling tagged to a coarser place, a million at least; else null.

    finest: the largest rounding unit of the parts.
    """
    unit, rest = rounding_unit(sibling), total - parts
    return F.when((unit >= 1e6) & (rest > 0) & (finest < unit) & (F.abs(rest - sibling) <= unit / 2), rest)


def significant(value: Column) -> Column:
    """A million at least, and three digits before its closing zeros."""
    digits = F.length(F.regexp_replace(F.format_string("%.0f", F.abs(value)), "0+$", ""))
    return (F.abs(value) >= 1e6) & (digits >= 3)


def relative_gap(parts: Column, total: Column) -> Column:
    """(parts - total) / |total|, null without a total."""
    return (parts - total) / F.nullif(F.abs(total), F.lit(0.0))


def differs(a: Column, b: Column, share: float = 0.005) -> Column:
    """Apart by more than a share of the larger."""
    return F.abs(a - b) > F.greatest(F.abs(a), F.abs(b)) * share


def _near_fraction(value: Column) -> Column:
    """struct(gap, d, n): the fraction n / d nearest a value, d from 1 to 4, of equal ones the least d."""
    each = [F.struct(F.abs(F.rint(value * d) / d - value).alias("gap"), F.lit(d).alias("d"), F.rint(value * d).alias("n")) for d in (1, 2, 3, 4)]
    return F.array_min(F.array(*each))


def declared_ratio(ratio: Column) -> Column:
    """The split ratio nearest a measured one: whole up to 100, or ten or less over two to four, or the inverse of one; null below 1.2."""
    value = F.when(ratio >= 1, ratio).otherwise(1 / ratio)
    near, whole = _near_fraction(value), F.rint(value)
    fits = F.array_compact(F.array(
        F.when(whole <= 100, F.struct(F.abs(whole - value).alias("gap"), F.lit(0).alias("k"), whole.alias("r"))),
        F.when((near["d"] > 1) & (near["n"] <= 10), F.struct(near["gap"].alias("gap"), F.lit(1).alias("k"), (near["n"] / near["d"]).alias("r"))),
    ))
    best = F.array_min(fits)["r"]
    return F.when(best >= 1.2, F.when(ratio >= 1, best).otherwise(1 / best))


def clean_ratio(ratio: Column) -> Column:
    """A ratio within 1% of a whole number or a fraction of up to four, 5/4 at least, or the inverse of one, as that; else null."""

    def exact(value: Column, inverse: bool) -> Column:
        near = _near_fraction(value)
        r = near["n"] / near["d"]
        return F.when((r >= 1.25) & (F.abs(r - value) <= 0.01 * value), 1 / r if inverse else r)

    return F.coalesce(exact(ratio, False), exact(1 / ratio, True))


def growth_matches(value: Column, before: Column, stated_percent: Column, points: float = 0.1) -> Column:
    """Whether a stated growth in percent is what two figures give."""
    return F.abs((value / F.nullif(before, F.lit(0.0)) - 1) * 100 - stated_percent) <= points


def scale_cascade(*sources: tuple[str, Column]) -> Column:
    """struct(factor, source) of the first source, in the order given, that states a factor."""
    return F.coalesce(*[F.when(c.isNotNull(), F.struct(c.cast("double").alias("factor"), F.lit(n).alias("source"))) for n, c in sources])
