"""Person lines of an assessment report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow.functions.text import trim_spaces

# Fixed value: a score, as in ``FIRST LAST - a: 51/100, b: 19/32``.
SCORE = r"([0-9]{1,3})/"


def drop_returns(c: Column) -> Column:
    return F.replace(c, F.lit("\r"), F.lit(""))


def first_word(c: Column) -> Column:
    return F.split(c, " ")[0]


def has_dash(line: Column) -> Column:
    return F.contains(line, F.lit("-"))


def _after_dash(line: Column) -> Column:
    """Text after the last dash; empty without a dash."""
    return F.when(has_dash(line), F.substring_index(line, "-", -1)).otherwise(F.lit(""))


def names_part(line: Column) -> Column:
    """Text before the last dash, without commas."""
    names = F.substr(line, F.lit(1), F.length(line) - F.length(_after_dash(line)) - F.lit(1))
    return F.when(has_dash(line), F.replace(names, F.lit(","), F.lit(""))).otherwise(F.lit(""))


def first_name(line: Column) -> Column:
    return trim_spaces(first_word(names_part(line)))


def last_name(line: Column) -> Column:
    """Everything after the first blank; empty for a one-word name."""
    names = names_part(line)
    blank = F.instr(names, " ")
    return F.when(blank == 0, F.lit("")).otherwise(trim_spaces(F.substr(names, blank + F.lit(1))))


def _score(field: Column) -> Column:
    return F.nullif(F.regexp_extract(field, SCORE, 1), F.lit("")).try_cast("int")


def psychometrics(line: Column) -> Column:
    """Score in the second-last comma field after the dash."""
    rest = _after_dash(line)
    field = F.substring_index(F.substring_index(rest, ",", -2), ",", 1)
    return _score(F.when(F.contains(rest, F.lit(",")), field))


def presentation(line: Column) -> Column:
    """Score in the last comma field."""
    return _score(F.substring_index(_after_dash(line), ",", -1))
