"""Period text and the fiscal calendar, as Column expressions.

All functions propagate NULL, use no Python code and never raise on bad text:
dates are made with ``try_cast`` because ANSI mode is on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
DAYS_PER_MONTH = 30.4
QUARTER_MONTHS, QUARTER_TOLERANCE = 3.0, 0.35
ANNUAL_MONTHS, ANNUAL_TOLERANCE = 12.0, 1.0
DATE_TOLERANCE_DAYS = 7
ANNUAL_FORMS = ("10-K", "10-K/A", "20-F", "20-F/A")
QUARTERLY_FORMS = ("10-Q", "10-Q/A")
SHORTEST_YEAR, LONGEST_PERIOD_DAYS, YEARS_AHEAD = 1990, 548, 2
QUARTERLY_WORDS = ("three months", "3 months", "three-months", "quarter", "quarterly", "q1", "q2", "q3", "q4")
CUMULATIVE_WORDS = (
    "six months", "6 months", "six-months", "nine months", "9 months", "nine-months", "twelve months", "12 months", "twelve-months",
    "year to date", "ytd", "cumulative",
)
ANNUAL_WORDS = ("twelve months", "12 months", "twelve-months", "year ended", "annual", "yearly")
FOREIGN_ANNUAL_FORMS = ("20-F", "20-F/A")
FINANCIAL_FORMS = ("10-K", "10-Q", "20-F", "20-F/A")
CONVENTION_CONCEPTS = (
    "Revenues", "SalesRevenueNet", "RevenueFromContractWithCustomerExcludingAssessedTax", "GrossProfit", "OperatingIncomeLoss",
    "NetIncomeLoss", "Assets",
)
PERIOD_TYPES = {
    "annual": ("annual", "annually", "yearly", "year"),
    "quarterly": ("quarterly", "quarter", "q1", "q2", "q3", "q4"),
    "interim": ("interim", "semi-annual", "semiannual", "half-year"),
}


def as_col(x: Column | str | int | float | None) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def lenient_date(text: Column) -> Column:
    """Date of an ISO text, from its first ten characters."""
    return F.substring(text.cast("string"), 1, 10).try_cast("date")


def period_start(period: Column) -> Column:
    """Start of "A to B"; NULL for a bare date, which is an end."""
    parts = F.split(period, " to ")
    return F.when(F.size(parts) == 2, lenient_date(F.trim(F.get(parts, F.lit(0)))))


def period_end(period: Column) -> Column:
    parts = F.split(period, " to ")
    return lenient_date(F.trim(F.when(F.size(parts) == 2, F.get(parts, F.lit(1))).otherwise(period)))


def label_date(label: Column) -> Column:
    """First yyyy-mm-dd inside a label."""
    return F.regexp_extract(label, r"(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def months_between_days(start: Column, end: Column) -> Column:
    """Length in months of 30.4 days."""
    return F.datediff(end, start) / F.lit(DAYS_PER_MONTH)


def duration_days(period: Column) -> Column:
    """Days of a range; NULL for an instant."""
    return F.datediff(period_end(period), period_start(period))


def period_key(period: Column) -> Column:
    """End date of a range, else the date that the text begins with, else the text."""
    end = F.regexp_extract(period, r" to (\d{4}-\d{2}-\d{2})", 1)
    first = F.regexp_extract(period, r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.coalesce(F.nullif(end, F.lit("")), F.nullif(first, F.lit("")), period)


def plain_key(key: Column) -> Column:
    """"2025-03-31 (Q1)" as "2025-03-31"."""
    trimmed = F.trim(key)
    return F.coalesce(F.nullif(F.regexp_extract(trimmed, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")), trimmed)


def orderable_period(label: Column) -> Column:
    """Date that orders "yyyy-Qn" (its last day), "yyyy" (31 December) and dates."""
    year, quarter = F.regexp_extract(label, r"^(\d{4})", 1), F.regexp_extract(label, r"^\d{4}-Q([1-4])$", 1)
    end = F.last_day(F.concat(year, F.lit("-"), F.lpad((quarter.try_cast("int") * 3).cast("string"), 2, "0"), F.lit("-01")).try_cast("date"))
    return F.when(quarter != "", end).when(label.rlike(r"^\d{4}$"), F.concat(year, F.lit("-12-31")).try_cast("date")).otherwise(lenient_date(label))


def period_type(text: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    out = F.when(low == "", F.lit("unknown"))
    for name, words in PERIOD_TYPES.items():
        out = out.when(low.isin(*words), F.lit(name))
    return out.otherwise(low)


def _mentions(text: Column, words: tuple[str, ...]) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return F.coalesce(out, F.lit(False))


def is_quarterly_heading(text: Column) -> Column:
    return _mentions(text, QUARTERLY_WORDS)


def is_cumulative_heading(text: Column) -> Column:
    return _mentions(text, CUMULATIVE_WORDS)


def is_annual_heading(text: Column) -> Column:
    return _mentions(text, ANNUAL_WORDS)


def cumulative_penalty(text: Column) -> Column:
    """How bad a heading is for a quarter: nine months are worse than six, a year is worst."""
    return (
        F.when(_mentions(text, ("six months", "6 months")), 75)
        .when(_mentions(text, ("nine months", "9 months")), 100)
        .when(_mentions(text, ("twelve months", "12 months", "year")), 150)
        .otherwise(50)
    )


def period_class(text: Column) -> Column:
    """quarterly, cumulative, annual or other, by the words of a column heading."""
    return F.when(is_quarterly_heading(text), "quarterly").when(is_annual_heading(text), "annual").when(is_cumulative_heading(text), "cumulative").otherwise("other")


def period_choice(heading: Column, form: Column) -> Column:
    """struct(valid, reason): whether a column heading suits a form."""
    quarterly, cumulative, annual = is_quarterly_heading(heading), is_cumulative_heading(heading), is_annual_heading(heading)
    reason = (
        F.when(F.coalesce(heading, F.lit("")) == "", "none")
        .when((form == "10-Q") & cumulative & ~quarterly, "cumulative")
        .when((form == "10-Q") & ~quarterly, "not quarterly")
        .when(form.isin(*ANNUAL_FORMS) & quarterly & ~annual, "quarterly")
    )
    return F.struct(reason.isNull().alias("valid"), F.coalesce(reason, F.lit("ok")).alias("reason"))


def is_primary_period(period: Column, form: Column, as_of: Column) -> Column:
    """Whether a period is a current one: months of a range by the form, an instant of the last three years before ``as_of``."""
    start, end = period_start(period), period_end(period)
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    quarter, year = months.between(2.5, 4.0), months.between(11.0, 13.0)
    length = F.when(form == "10-Q", quarter).when(F.coalesce(form.isin(*ANNUAL_FORMS), F.lit(False)), year).otherwise(quarter | year)
    instant = end >= F.date_sub(as_of, 3 * 365)
    return F.coalesce(F.when(period.contains(" to "), length).otherwise(instant), F.lit(False))


def in_years(form: Column, filing_date: Column, report_date: Column, code: Column, first: int, last: int | None = None) -> Column:
    """Whether a filing belongs to a range of years: its filing year or its fiscal year may satisfy either bound.

    Only financial forms; a foreign annual form needs a report date that can be read.
    """
    filed, reported = F.year(lenient_date(filing_date)), lenient_date(report_date)
    fiscal = fiscal_year_of(reported, code)
    known = form.isin(*FINANCIAL_FORMS) & (~form.isin(*FOREIGN_ANNUAL_FORMS) | reported.isNotNull()) & filed.isNotNull()
    out = known & ((filed >= first) | F.coalesce(fiscal >= first, F.lit(False)))
    if last is not None:
        out = out & ((filed <= last) | F.coalesce(fiscal <= last, F.lit(False)))
    return F.coalesce(out, F.lit(False))


def valid_dates(start: Column, end: Column, as_of: Column) -> Column:
    """Years in range, start before end, at most 548 days; ``as_of`` stands for today."""
    in_range = (F.year(end) >= SHORTEST_YEAR) & (F.year(end) <= F.year(as_of) + YEARS_AHEAD)
    length = F.datediff(end, start)
    return F.coalesce(in_range & (start.isNull() | ((length > 0) & (length <= LONGEST_PERIOD_DAYS))), F.lit(False))


def display_label(fiscal_year: Column, quarter: Column) -> Column:
    year = fiscal_year.cast("string")
    return F.when(quarter.isNull(), F.concat(F.lit("FY "), year)).otherwise(F.concat(F.lit("Q"), quarter.cast("string"), F.lit(" "), year))


def period_label(period: Column) -> Column:
    """Heading of a period's text: FY of a whole calendar year (1 January to 1 January), Qn of three months from a quarter's first month, else the range; "As of" an instant."""
    ranged = period.contains(" to ")
    parts = F.split(period, " to ")
    first, last = (F.get(F.split(F.get(parts, F.lit(k)), " "), F.lit(0)) for k in (0, 1))
    s, e = first.try_cast("date"), last.try_cast("date")
    new_year = lambda d: (F.month(d) == 1) & (F.day(d) == 1)
    whole = new_year(s) & new_year(e) & (F.year(e) == F.year(s) + 1)
    three = (F.year(e) * 12 + F.month(e) - F.year(s) * 12 - F.month(s) == 3) & F.month(s).isin(1, 4, 7, 10)
    out = F.when(whole, F.concat(F.lit("FY "), F.year(s).cast("string"))).when(three, F.concat(F.lit("Q"), F.quarter(s).cast("string"), F.lit(" "), F.year(s).cast("string"))).otherwise(F.concat_ws(" to ", first, last))
    instant = F.concat(F.lit("As of "), F.get(F.split(period, " "), F.lit(0)))
    return F.when(F.coalesce(period, F.lit("")) == "", "Unknown Period").when(ranged & (F.size(parts) == 2), out).when(ranged, period).otherwise(instant)


def latest_label(labels: Column) -> Column:
    """The label of the latest period of an array; the first of equally late ones."""
    n = F.size(labels)
    ranked = F.transform(labels, lambda x, i: F.struct(orderable_period(x).alias("d"), (n - i).alias("k"), x.alias("label")))
    return F.array_max(F.filter(ranked, lambda r: r["d"].isNotNull()))["label"]


def filing_period(form: Column, report_date: Column, code: Column, convention: Column, stated_year: Column, stated_quarter: Column) -> Column:
    """struct(end_date, period_type, fiscal_year, quarter) of a filing's metadata; a stated year (1990 to 2100) and quarter (1 to 4) win, annual forms have no quarter."""
    end = lenient_date(report_date)
    annual = F.coalesce(form.isin(*ANNUAL_FORMS), F.lit(False))
    conv = F.coalesce(convention, F.lit("end"))
    year = F.coalesce(F.when(stated_year.between(1990, 2100), stated_year), fiscal_year_of(end, code, conv))
    quarter = F.when(~annual, F.coalesce(F.when(stated_quarter.between(1, 4), stated_quarter), fiscal_quarter_of(end, code, conv)))
    return F.struct(end.alias("end_date"), F.when(annual, "annual").otherwise("quarterly").alias("period_type"), year.alias("fiscal_year"), quarter.alias("quarter"))


def standard_period(start: Column, end: Column, primary: Column, kind: Column, form: Column, code: Column, fiscal_year: Column, quarter: Column, xbrl_period: Column) -> Column:
    """struct(start_date, fiscal_year, quarter, source, period_type): a reporting period with what is missing filled in.

    The start comes from the primary period's text, else it is a year or three
    months (less a day) before the end. For quarterly periods the document's own
    Qn wins; a quarter that is missing is found from the form and the date.
    """
    first = F.coalesce(start, F.when(primary.isNotNull(), period_start(primary)).otherwise(standard_start(start, end, kind == "annual")))
    known = end.isNotNull() & code.isNotNull()
    own = F.when(known & (kind == "quarterly"), F.regexp_extract(F.upper(xbrl_period), r"Q([1-4])", 1).try_cast("int"))
    found = F.when(known & (kind == "quarterly") & quarter.isNull() & own.isNull(), quarter_by_form(form, end, code))
    year = F.coalesce(fiscal_year, F.when(known, fiscal_year_of(end, code)))
    source = F.when(own.isNotNull(), "xbrl_document").when(found.isNotNull(), "form_type_and_date")
    return F.struct(first.alias("start_date"), year.alias("fiscal_year"), F.coalesce(own, quarter, found).alias("quarter"), source.alias("source"), F.when(kind.isNotNull(), period_type(kind)).alias("period_type"))


def detected_period(end: Column, quarter: Column, fiscal_year: Column, kind: Column, form: Column, label: Column) -> Column:
    """struct(period_type, period_end, quarter, label, fiscal_year, short_label); NULL without an end."""
    low = F.lower(F.coalesce(kind, F.lit("")))
    made = F.when(low == "annual", "annual").when(low.isin("quarterly", "interim"), "quarterly").when(F.upper(form) == "10-K", "annual").when(F.upper(form) == "10-Q", "quarterly").when(quarter.isNotNull() & (quarter != 0), "quarterly").otherwise("annual")
    year, q = F.coalesce(fiscal_year, F.year(end)), F.when(made != "annual", quarter)
    words = F.concat(F.when(made == "annual", "Fiscal Year Ended ").otherwise("Three Months Ended "), end.cast("string"))
    short = F.concat(F.lit("FY"), year.cast("string"), F.when(q.isNotNull(), F.concat(F.lit(" Q"), q.cast("string"))).otherwise(" (annual)"))
    return F.when(end.isNotNull(), F.struct(made.alias("period_type"), end.alias("period_end"), q.alias("quarter"), F.coalesce(F.nullif(label, F.lit("")), words).alias("label"), year.alias("fiscal_year"), short.alias("short_label")))


# --- fiscal calendar --------------------------------------------------------


def _code(code: Column) -> Column:
    """MMDD or NULL."""
    return F.when(code.rlike(r"^\d{4}$"), code)


def _nearest_weekday(anchor: Column, weekday: Column) -> Column:
    ahead = F.pmod(weekday - F.weekday(anchor), F.lit(7))
    return F.date_add(anchor, F.when(ahead > 3, ahead - 7).otherwise(ahead).cast("int"))


def fiscal_year_end(fiscal_year: Column, code: Column, convention: Column | str = "end", weekday: Column | None = None) -> Column:
    """Last day of a fiscal year; NULL for 0229 in a common year.

    ``convention``: 'end' names a year by the calendar year in which it ends,
    'start' names years that end in January or February by the year before.
    ``weekday`` (0 Monday): the nearest such day, three days away at most.
    """
    c = _code(code)
    month = F.substring(c, 1, 2)
    later = (as_col(convention) == "start") & month.isin("01", "02")
    year = fiscal_year + F.when(later, 1).otherwise(0)
    day = F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), month, F.lit("-"), F.substring(c, 3, 2)).try_cast("date")
    return day if weekday is None else F.when(weekday.isNull(), day).otherwise(_nearest_weekday(day, weekday))


def fiscal_year_start(fiscal_year: Column, code: Column, convention: Column | str = "end", weekday: Column | None = None) -> Column:
    return F.date_add(fiscal_year_end(fiscal_year - 1, code, convention, weekday), 1)


def fiscal_year_of(day: Column, code: Column, convention: Column | str = "end", weekday: Column | None = None) -> Column:
    """The first of the years y-1, y, y+1 that holds ``day`` with a week's tolerance, else the one that ends nearest."""
    years = [F.year(day) + k for k in (-1, 0, 1)]
    ends = [fiscal_year_end(y, code, convention, weekday) for y in years]
    inside = [
        F.when((day >= F.date_sub(fiscal_year_start(y, code, convention, weekday), DATE_TOLERANCE_DAYS)) & (day <= F.date_add(e, DATE_TOLERANCE_DAYS)), y)
        for y, e in zip(years, ends, strict=True)
    ]
    gaps = [F.when(e.isNotNull(), F.struct(F.abs(F.datediff(day, e)).alias("gap"), y.alias("year"))) for y, e in zip(years, ends, strict=True)]
    return F.coalesce(*inside, F.array_min(F.array_compact(F.array(*gaps)))["year"])


def quarter_start(fiscal_year: Column, quarter: Column | int, code: Column, convention: Column | str = "end", weekday: Column | None = None) -> Column:
    return F.add_months(fiscal_year_start(fiscal_year, code, convention, weekday), (as_col(quarter) - 1) * 3)


def quarter_end(fiscal_year: Column, quarter: Column | int, code: Column, convention: Column | str = "end", weekday: Column | None = None) -> Column:
    return F.date_sub(F.add_months(quarter_start(fiscal_year, quarter, code, convention, weekday), 3), 1)


def fiscal_quarter_of(day: Column, code: Column, convention: Column | str = "end", weekday: Column | None = None) -> Column:
    """The quarter whose end is nearest; the earlier one on a tie; NULL without a fiscal year."""
    fy = fiscal_year_of(day, code, convention, weekday)
    options = F.array(*[F.struct(F.abs(F.datediff(day, quarter_end(fy, q, code, convention, weekday))).alias("gap"), F.lit(q).alias("q")) for q in (1, 2, 3, 4)])
    return F.when(fy.isNotNull(), F.array_min(options)["q"])


def quarter_by_form(form: Column, day: Column, code: Column) -> Column:
    return F.when(form == "10-K", F.lit(4)).when(form == "10-Q", fiscal_quarter_of(day, code))


def is_quarterly_length(months: Column) -> Column:
    return F.abs(months - QUARTER_MONTHS) <= QUARTER_TOLERANCE


def is_annual_length(months: Column) -> Column:
    return F.abs(months - ANNUAL_MONTHS) <= ANNUAL_TOLERANCE


def matches_form(start: Column, end: Column, target_end: Column, form: Column) -> Column:
    """End within a week of the target, and the length that the form calls for."""
    months = months_between_days(start, end)
    near = F.abs(F.datediff(end, target_end)) <= DATE_TOLERANCE_DAYS
    return near & F.when(form.isin(*ANNUAL_FORMS), is_annual_length(months)).otherwise(is_quarterly_length(months))


def convention_from_anchor(end: Column, code: Column, labelled_year: Column) -> Column:
    """'end' or 'start' if exactly one convention gives the labelled year."""
    as_end = fiscal_year_of(end, code, "end") == labelled_year
    as_start = fiscal_year_of(end, code, "start") == labelled_year
    return F.when(as_end & ~as_start, F.lit("end")).when(as_start & ~as_end, F.lit("start"))


def fiscal_year_chain(entity_year: Column, end: Column, code: Column, uri: Column) -> Column:
    """Declared year (1990 to 2100), calendar year by the fiscal calendar, year in the document's name, year of the end date."""
    stated = F.when(entity_year.between(1990, 2100), entity_year)
    named = F.regexp_extract(uri, r"(19\d{2}|20\d{2})(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])", 1).try_cast("int")
    short = F.regexp_extract(uri, r"\d{10}-(\d{2})-\d{6}", 1).try_cast("int")
    return F.coalesce(stated, fiscal_year_of(end, code), named, F.when(short >= 50, short + 1900).otherwise(short + 2000), F.year(end))


def standard_start(start: Column, end: Column, annual: Column) -> Column:
    """Start of a period; a missing one is 12 or 3 months before the end, plus a day."""
    return F.coalesce(start, F.date_add(F.add_months(end, F.when(annual, -12).otherwise(-3)), 1))
