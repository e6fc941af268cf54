"""Months, weeks and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def shift_month(month: Column, n: int) -> Column:
    """'YYYY-MM' moved by n months."""
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), n), "yyyy-MM")


def week_end(c: Column) -> Column:
    """The Saturday that ends the week of a date (weeks are Sunday to Saturday)."""
    day = c.cast("date")
    return F.date_add(day, F.lit(7) - F.dayofweek(day))


def saturday_on_or_before(day: Column) -> Column:
    return F.date_sub(day, F.pmod(F.dayofweek(day), F.lit(7)).cast("int"))


def latest_published_saturday(today: Column, lag_days: int = 5) -> Column:
    return saturday_on_or_before(F.date_sub(today, lag_days))


def n_saturdays(month: Column) -> Column:
    """Saturdays in the month that starts at a date."""
    days = F.sequence(month, F.last_day(month))
    return F.size(F.filter(days, lambda d: F.dayofweek(d) == 7))


def last_closed_month(today: Column, safety_day: int = 5) -> Column:
    """The newest month whose report is safe to ask for: last month after the safety day, else the one before."""
    return F.add_months(F.trunc(today, "month"), F.when(F.day(today) > safety_day, -1).otherwise(-2))


def is_whole_period(kind: Column, start: Column, end: Column) -> Column:
    """MONTH: a calendar month; WEEK: Sunday to Saturday; null or another kind: false."""
    month = (F.day(start) == 1) & (end == F.last_day(start))
    week = (F.dayofweek(start) == 1) & (end == F.date_add(start, 6))
    return F.coalesce(F.when(kind == "MONTH", month).when(kind == "WEEK", week), F.lit(False))


#: Month names of three languages by number.
MONTH_NAMES = {
    "en": ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"),
    "de": ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"),
    "es": ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"),
}


def localised_date(text: Column) -> Column:
    """ISO, 'May 3, 2024', '3. Mai 2024' or '3 de mayo de 2024'; what comes before 'on' or 'vom' is cut off."""
    names = {n.lower(): i for lang in MONTH_NAMES.values() for i, n in enumerate(lang, 1)}
    number = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    t = F.trim(F.regexp_replace(text, r"(?i)^.*\b(?:on|vom|el)\s+", ""))
    day_first, month_first = r"(?i)^(\d{1,2})\.?\s+(?:de\s+)?([^\d\s]+)\s+(?:de\s+)?(\d{4})$", r"(?i)^([^\d\s]+)\s+(\d{1,2}),?\s+(\d{4})$"

    def made(pattern: str, day: int, month: int) -> Column:
        m = F.try_element_at(number, F.lower(F.regexp_extract(t, pattern, month)))
        return F.when(t.rlike(pattern), F.try_to_date(F.format_string("%s-%02d-%02d", F.regexp_extract(t, pattern, 3), m, F.regexp_extract(t, pattern, day).try_cast("int"))))

    return F.coalesce(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.left(t, F.lit(10)))), made(day_first, 1, 2), made(month_first, 2, 1))


def another_saturday_due(end: Column, through: Column) -> Column:
    """Is the month of the week's end the newest loaded month, with a Saturday still to come?"""
    return (F.last_day(end) == F.last_day(through)) & (F.date_add(through, 7) <= F.last_day(through))


def iso_instant(text: Column, with_time: bool = True) -> Column:
    """'YYYY-MM-DDTHH:mm:ss.SSSZ' (UTC) or 'YYYY-MM-DD' of a timestamp text; null where it is none."""
    at = F.try_to_timestamp(F.trim(text))
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'" if with_time else "yyyy-MM-dd")


def month_of(year: Column, name: Column) -> Column:
    """'YYYY-MM' of a year and an English month name, in full or its first three letters; null where either cannot be read."""
    names = {n.lower()[:k]: i for i, n in enumerate(MONTH_NAMES["en"], 1) for k in (3, len(n))}
    number = F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.lower(F.trim(name)))
    y = year.try_cast("double").try_cast("int")
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(number.cast("string"), 2, "0"))
