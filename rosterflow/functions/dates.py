"""Date parsing and rendering. Bad text gives null, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings accepted for the date line of an assessment report, tried in turn.
FREE_FORMATS = (
    "d MMMM yyyy",
    "d MMM yyyy",
    "MMMM d yyyy",
    "MMM d yyyy",
    "yyyy-MM-dd",
    "M/d/yyyy",
    "d/M/yyyy",
)
NO_DATE = "00000000"  # id date of rows before the first dated row of their file


def repair_slashes(c: Column) -> Column:
    return F.replace(c, F.lit("//"), F.lit("/"))


def parse_dmy(c: Column) -> Column:
    """Day-first date such as 22/08/2019."""
    return F.try_to_date(c, "d/M/yyyy")


def strict_dmy(c: Column) -> Column:
    """As ``parse_dmy`` but a bad value fails the job (ANSI mode)."""
    return F.to_date(c, "d/M/yyyy")


def invite_date(day: Column, month: Column) -> Column:
    """Date from a day such as ``10.0`` and a month such as ``April 2019`` or ``SEPT 2019``."""
    number = day.cast("string").try_cast("double").try_cast("int")
    name = F.initcap(F.substring(F.trim(month), 1, 3))
    year = F.regexp_extract(month, r"(\d{4})", 1)
    text = F.concat(number.cast("string"), F.lit(" "), name, F.lit(" "), year)
    return F.try_to_date(text, "d MMM yyyy")


def free_text_date(c: Column) -> Column:
    """Date from text such as ``Wednesday 1 May 2019``; the weekday is not checked."""
    text = F.regexp_replace(F.trim(c), r"(?i)^[a-z]+day\b,?\s*", "")
    text = F.regexp_replace(text, r"(?i)(\d)(st|nd|rd|th)\b", "$1")
    text = F.initcap(F.regexp_replace(F.replace(text, F.lit(","), F.lit(" ")), r"\s+", " "))
    return F.coalesce(*[F.try_to_date(text, f) for f in FREE_FORMATS])


def compact_date(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def month_only(c: Column) -> Column:
    """``yyyyMM00``, the id date of a row that borrows its predecessor's date."""
    return F.concat(F.date_format(c, "yyyyMM"), F.lit("00"))
