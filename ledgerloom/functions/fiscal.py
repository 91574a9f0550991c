"""Fiscal calendars: year ends given as MMDD, quarters by days since the last year end, classes of durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import let

# Day windows from the last year end, slack of a year end, and of a company's own quarter end.
Q1_DAYS, Q2_DAYS, Q3_DAYS, SLACK, OWN_SLACK = (74, 122), (158, 206), (242, 290), 10, 31
# Days of each class of duration.
QUARTER_DAYS, NINE_MONTHS_DAYS, YEAR_DAYS, YEAR_AGO_DAYS = (80, 100), (250, 290), (330, 400), (358, 372)
# Days, both ends counted, of the durations of a statement's columns; days after a quarter in which its results come.
SPANS = (("quarter", 80, 122), ("ytd", 165, 210), ("ytd", 245, 295), ("year", 350, 380))
RESULTS_DAYS = 75
ANNUAL_FORMS = ("10-K", "20-F", "40-F")
LABEL = "struct<fiscal_year:int,fiscal_period:string>"


def year_end(year: Column, mmdd: Column) -> Column:
    """The nominal end of a fiscal year, its day clipped to the month."""
    first = F.make_date(year, F.substring(mmdd, 1, 2).cast("int"), F.lit(1))
    return F.date_add(first, F.least(F.substring(mmdd, 3, 2).cast("int"), F.dayofmonth(F.last_day(first))) - 1)


def fiscal_year_end_for(day: Column, mmdd: Column) -> Column:
    """The nominal end of the fiscal year that holds a day, which may lie up to the slack after it."""
    this = year_end(F.year(day), mmdd)
    ahead = F.date_diff(this, day)
    return F.when(ahead < -SLACK, year_end(F.year(day) + 1, mmdd)).when(ahead > 366 - SLACK, year_end(F.year(day) - 1, mmdd)).otherwise(this)


def fiscal_label(day: Column, mmdd: Column, annual: Column | bool = False, offset: Column | int = 0) -> Column:
    """struct(fiscal_year, fiscal_period) of a period's last day; null off the calendar.

    Within the slack of the year end it is Q4, of an annual period FY, which can end nowhere else; Q1 to Q3 by days since
    the year end before. offset: what the company's naming adds to the calendar year of the year end.
    """
    annual = F.lit(annual) if isinstance(annual, bool) else annual
    offset = F.lit(offset) if isinstance(offset, int) else offset

    def label(end: Column) -> Column:
        closes = F.abs(F.date_diff(end, day)) <= SLACK
        days = F.date_diff(day, year_end(F.year(end) - 1, mmdd))
        quarter = F.when(days.between(*Q1_DAYS), "Q1").when(days.between(*Q2_DAYS), "Q2").when(days.between(*Q3_DAYS), "Q3")
        period = F.when(annual, F.when(closes, "FY")).when(closes, "Q4").otherwise(quarter)
        return F.when(period.isNotNull(), F.struct((F.year(end) + offset).cast("int").alias("fiscal_year"), period.alias("fiscal_period")))

    return let(fiscal_year_end_for(day, mmdd), label)


def duration_class(start: Column, end: Column) -> Column:
    """instant, quarter, nine_months, year or ytd by the days between."""
    days = F.date_diff(end, start)
    return (
        F.when(start.isNull() | (days == 0), "instant").when(days.between(*QUARTER_DAYS), "quarter")
        .when(days.between(*NINE_MONTHS_DAYS), "nine_months").when(days.between(*YEAR_DAYS), "year").when(days > 0, "ytd")
    )


def statement_duration(start: Column, end: Column) -> Column:
    """instant without a start, else quarter, ytd or year; null for a span no statement uses."""
    days = F.date_diff(end, start) + 1
    return F.coalesce(F.when(start.isNull(), "instant"), *[F.when(days.between(low, high), name) for name, low, high in SPANS])


def label_period(start: Column, end: Column, mmdd: Column, offset: Column | int = 0) -> Column:
    """struct(fiscal_year, fiscal_period, duration) of a statement's column; null for a span no statement uses or off the calendar.

    A balance at the year end is the year's; six or nine months end only at a second or third quarter.
    """
    kind = statement_duration(start, end)

    def named(x: Column) -> Column:
        label, k = x["label"], x["kind"]
        period = F.when((k == "instant") & (label["fiscal_period"] == "Q4"), "FY").otherwise(label["fiscal_period"])
        ok = label.isNotNull() & k.isNotNull() & ((k != "ytd") | label["fiscal_period"].isin("Q2", "Q3"))
        return F.when(ok, F.struct(label["fiscal_year"].alias("fiscal_year"), period.alias("fiscal_period"), k.alias("duration")))

    return let(F.struct(fiscal_label(end, mmdd, kind == "year", offset).alias("label"), kind.alias("kind")), named)


def short_first_year(start: Column, end: Column, first_start: Column, mmdd: Column, form: Column, offset: Column | int = 0) -> Column:
    """struct(fiscal_year, fiscal_period, duration) of a first fiscal year that began within it, else null.

    Of a statement's columns the earliest (first_start is the least start of all), 28 to 349 days long, ending within a
    week of the year end; never a transition report's.
    """
    days, end_of_year = F.date_diff(end, start) + 1, year_end(F.year(end), mmdd)
    ok = ~F.upper(form).startswith("10-KT") & days.between(28, 349) & (start <= first_start) & (F.abs(F.date_diff(end, end_of_year)) <= 7)
    label = fiscal_label(end, mmdd, True, offset)
    return F.when(ok & label.isNotNull(), F.struct(label["fiscal_year"].alias("fiscal_year"), F.lit("FY").alias("fiscal_period"), F.lit("year").alias("duration")))


def own_end(nominal: Column, own_ends: Column) -> Column:
    """The company's own quarter end near a nominal one, else the one 52 weeks before it moved on, else the nominal one.

    own_ends: an array of dates. A quarter that ended within three days of its date a year ago keeps its date.
    """
    nearest = lambda ends: F.array_min(F.transform(ends, lambda e: F.struct(F.abs(F.date_diff(e, nominal)).alias("gap"), e.alias("end"))))["end"]
    near = F.filter(own_ends, lambda e: F.abs(F.date_diff(e, nominal)) <= OWN_SLACK)
    moved = F.transform(F.filter(own_ends, lambda e: F.abs(F.date_diff(e, F.add_months(nominal, -12))) > 3), lambda e: F.date_add(e, 364))
    moved = F.filter(moved, lambda e: F.abs(F.date_diff(e, nominal)) <= OWN_SLACK)
    return F.coalesce(nearest(near), nearest(moved), nominal)


def nominal_quarter_ends(year: Column, mmdd: Column) -> Column:
    """array of the four quarter ends of a fiscal year, the last first; month ends where the year ends on one."""

    def all_of(end: Column) -> Column:
        first, whole = F.trunc(end, "month"), F.dayofmonth(end) == F.dayofmonth(F.last_day(end))

        def back(k: int) -> Column:
            month = F.add_months(first, -k)
            return F.when(whole, F.last_day(month)).otherwise(F.date_add(month, F.least(F.dayofmonth(end), F.dayofmonth(F.last_day(month))) - 1))

        return F.array(*[back(k) for k in (0, 3, 6, 9)])

    return let(year_end(year, mmdd), all_of)


def quarter_end_before(day: Column, mmdd: Column, own_ends: Column | None = None, least_days: int = 5) -> Column:
    """The last fiscal quarter end that lies at least so many days before a filing; own ends of the company go first."""
    own_ends = F.array().cast("array<date>") if own_ends is None else F.coalesce(own_ends, F.array().cast("array<date>"))
    ends = F.flatten(F.array(*[nominal_quarter_ends(F.year(day) + k, mmdd) for k in (-1, 0, 1)]))
    own = F.transform(ends, lambda e: own_end(e, own_ends))
    return F.array_max(F.filter(own, lambda e: e <= F.date_sub(day, least_days)))


def release_period(day: Column, mmdd: Column, own_ends: Column | None = None) -> Column:
    """The quarter a furnished filing reports: that of quarter_end_before, unless results never come so late and a later one has closed."""
    usual = quarter_end_before(day, mmdd, own_ends)
    return F.when(F.date_diff(day, usual) <= RESULTS_DAYS, usual).otherwise(F.greatest(usual, quarter_end_before(day, mmdd, own_ends, 0)))


def mmdd_gap(a: Column, b: Column) -> Column:
    """Days between two year ends, the shorter way round the year."""
    on = lambda c: F.make_date(F.lit(2001), F.substring(c, 1, 2).cast("int"), F.least(F.substring(c, 3, 2).cast("int"), F.when(F.substring(c, 1, 2) == "02", 28).otherwise(31)))
    days = F.abs(F.date_diff(on(a), on(b)))
    return F.least(days, 365 - days)


def year_end_at(period_end: Column, annual_ends: Column, usual: Column) -> Column:
    """A company's year end as of a period: that of the annual report that closes its year (within 375 days), the usual one if within 15 days of that or without one."""
    closing = F.array_min(F.filter(annual_ends, lambda e: F.date_diff(e, period_end).between(0, 375)))
    found = F.date_format(closing, "MMdd")
    return F.when(found.isNull() | (mmdd_gap(found, usual) <= 15), usual).otherwise(found)


def stated_year_end(stated: Column, latest_annual: Column) -> Column:
    """A stated year end, replaced by that of the newest annual period where they are more than the slack apart."""
    found = F.date_format(latest_annual, "MMdd")
    return F.when(mmdd_gap(stated, found) > SLACK, found).otherwise(stated)


def opening_instant(start: Column, instants: Column) -> Column:
    """Of an array of balance dates the one a period opens with: the day before its start, or the nearest within a week before that."""
    before = F.date_sub(start, 1)
    return F.array_max(F.filter(instants, lambda d: F.date_diff(before, d).between(0, 7)))


def period_key(key: Column) -> Column:
    """struct(start, end) of `duration_a_b` or `instant_a`."""
    a, b = F.regexp_extract(key, r"^\w+?_(\d{4}-\d{2}-\d{2})", 1), F.regexp_extract(key, r"_(\d{4}-\d{2}-\d{2})$", 1)
    return F.when(key.startswith("duration_"), F.struct(a.try_cast("date").alias("start"), b.try_cast("date").alias("end"))).when(key.startswith("instant_"), F.struct(F.lit(None).cast("date").alias("start"), b.try_cast("date").alias("end")))


def _full_year(text: Column) -> Column:
    n = text.try_cast("int")
    return F.when(n < 50, n + 2000).when(n < 100, n + 1900).otherwise(n)


QUARTER_NAME = r"(?i)\b(?:Q([1-4])|([1-4])(?:(?:st|nd|rd|th)\s*(?:Q\b|quarter)|Q)|(first|second|third|fourth)\s+quarter)(?:\s+of)?\s*[,.'/-]?\s*((?:19|20)[0-9]{2}|[0-9]{2})\b"


def quarter_end(year: Column, number: Column, mmdd: Column) -> Column:
    """The end of a fiscal year's quarter; days from 28 on mean the month's end."""
    first = F.make_date(year, F.substring(mmdd, 1, 2).cast("int"), F.lit(1))
    month, day = F.add_months(first, -3 * (4 - number)), F.substring(mmdd, 3, 2).cast("int")
    return F.when(day >= 28, F.last_day(month)).otherwise(F.date_add(month, F.least(day, F.dayofmonth(F.last_day(month))) - 1))


def named_quarter(text: Column, mmdd: Column, offset: int = 0) -> Column:
    """The end of the fiscal quarter that a header names with its year: `Q3 2007`, `1Q08`, `Third Quarter 2007`."""
    part = lambda i: F.regexp_extract(text, QUARTER_NAME, i)
    ordinal = F.lower(part(3))
    number = F.coalesce(part(1).try_cast("int"), part(2).try_cast("int"), *[F.when(ordinal == w, i) for i, w in enumerate(("first", "second", "third", "fourth"), 1)])
    return quarter_end(_full_year(part(4)) - offset, number, mmdd)


def named_months(text: Column, mmdd: Column, offset: int = 0) -> Column:
    """struct(end, months) of months to date that a header names: `6M19` and `1H19` are the fiscal year's first six, `9M 2015` nine."""
    part = lambda i: F.regexp_extract(text, r"(?i)\b(3|6|9|12|1)\s*([MH])\s*['’]?\s*((?:19|20)[0-9]{2}|[0-9]{2})\b", i)
    half, n = F.lower(part(2)) == "h", part(1).try_cast("int")
    months = F.when(half, F.when(n == 1, 6)).when(n.isin(3, 6, 9, 12), n)
    end = quarter_end(_full_year(part(3)) - offset, (months / 3).cast("int"), mmdd)
    return F.when(months.isNotNull(), F.struct(end.alias("end"), months.alias("months")))


def day_first(text: Column) -> Column:
    """Whether slashed dates in a text read day first: one can only be read so and none only month first."""
    part = lambda i: F.regexp_extract_all(text, F.lit(r"\b([0-9]{1,2})/([0-9]{1,2})/(?:[0-9]{4}|[0-9]{2})\b"), F.lit(i))
    over = lambda a: F.exists(a, lambda x: x.cast("int") > 12)
    return over(part(1)) & ~over(part(2))


def numeric_date(text: Column, days_first: Column) -> Column:
    """The first slashed or dotted date of a text; two-digit years are 1950 to 2049; null for no such day."""
    part = lambda i: F.regexp_extract(text, r"\b([0-9]{1,2})[/.]([0-9]{1,2})[/.]([0-9]{4}|[0-9]{2})\b", i)
    day, month = F.when(days_first, part(1)).otherwise(part(2)), F.when(days_first, part(2)).otherwise(part(1))
    return F.concat_ws("-", _full_year(part(3)), month, day).try_cast("date")


def era(day: Column) -> Column:
    """The year end of an annual period as MMDD, by which runs of years of one calendar are told."""
    return F.date_format(day, "MMdd")


def available_from(accepted: Column, filed: Column, zone: str = "America/New_York") -> Column:
    """The time of acceptance, else the end of the filing day in the market's zone, as UTC."""
    return F.coalesce(accepted, F.to_utc_timestamp(F.date_add(filed, 1).cast("timestamp_ntz").cast("timestamp"), zone))
