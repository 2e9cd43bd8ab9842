"""Dates, seasons and calendar ranges from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: month names and abbreviations in posts
MONTHS = {
    "january": 1, "jan": 1, "february": 2, "feb": 2, "march": 3, "mar": 3, "april": 4, "apr": 4, "may": 5,
    "june": 6, "jun": 6, "july": 7, "jul": 7, "august": 8, "aug": 8, "september": 9, "sep": 9, "sept": 9,
    "october": 10, "oct": 10, "november": 11, "nov": 11, "december": 12, "dec": 12,
}
MONTH_WORDS = (
    "January|February|March|April|May|June|July|August|September|October|November|December"
    "|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec"
)
MONTH_DATE = rf"(?i)({MONTH_WORDS})\.?\s+(\d{{1,2}}),\s+(\d{{4}})"
PORTAL_DATE = r"(?i)entered portal\s+(\d+)/(\d+)/(\d+)"


def iso(year: Column, month: Column, day: Column) -> Column:
    return F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))


def us_date(value: Column) -> Column:
    """``m/d/yyyy`` to ISO text; blank passes through."""
    parts = F.split(value, "/")
    padded = F.concat_ws("-", parts[2], F.lpad(parts[0], 2, "0"), F.lpad(parts[1], 2, "0"))
    return F.when(value == "", value).otherwise(padded)


def day_month_year(value: Column) -> Column:
    """``21 Mar 2021`` to ISO text."""
    return F.date_format(F.try_to_date(value, "d MMM yyyy"), "yyyy-MM-dd")


def portal_date(value: Column) -> Column:
    """``entered portal m/d/yy`` anywhere in the text, years 20xx."""
    part = [F.regexp_extract(value, PORTAL_DATE, i) for i in (1, 2, 3)]
    return F.when(part[0] != "", iso(part[2].try_cast("int") + 2000, part[0].try_cast("int"), part[1].try_cast("int")))


def month_name_date(value: Column) -> Column:
    """First ``Month d, yyyy`` in the text, full or short month names."""
    name = F.lower(F.regexp_extract(value, MONTH_DATE, 1))
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    month = F.try_element_at(months, name)
    day, year = (F.regexp_extract(value, MONTH_DATE, i).try_cast("int") for i in (2, 3))
    return F.when(name != "", iso(year, month, day))


def event_date(day_month: Column, year: Column, limit: str = "2021-08-30", held: int = 2020) -> Column:
    """``ddmm`` with the event's year; dates past the limit belong to the year it was held."""
    text = F.lpad(F.trim(day_month), 4, "0")
    first = F.try_to_date(F.concat(text, year.cast("string")), "ddMMyyyy")
    second = F.try_to_date(F.concat(text, F.lit(str(held))), "ddMMyyyy")
    return F.when(first > F.lit(limit).cast("date"), second).otherwise(first)


def season_problem(season: Column) -> Column:
    """Why a ``YYYY-YY`` season is not valid; null when it is."""
    ok_shape = season.rlike(r"^\d{4}-\d{2}$")
    follows = (F.substring(season, 1, 4).try_cast("int") + 1) % 100 == F.substring(season, 6, 2).try_cast("int")
    return (
        F.when(season.isNull() | (season == ""), "empty")
        .when(~ok_shape, "format")
        .when(~follows, "not consecutive")
    )


def season_spellings(season: Column, start_only: Column | None = None) -> Column:
    """``2025-26``, ``2025 - 2026``, ``2025-2026`` and, where asked, ``2025``."""
    start, end = F.split(season, "-")[0], F.get(F.split(season, "-"), F.lit(1))
    full = F.concat(F.substring(start, 1, 2), end)
    base = F.array(season, F.concat_ws(" - ", start, full), F.concat_ws("-", start, full))
    two_parts = F.size(F.split(season, "-")) == 2
    listed = F.when(two_parts, base).otherwise(F.array(season))
    if start_only is None:
        return listed
    return F.when(two_parts & start_only, F.array_append(listed, start)).otherwise(listed)


def month_starts(first: Column, last: Column) -> Column:
    """First days of the months between two dates."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def days(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("interval 1 day"))
