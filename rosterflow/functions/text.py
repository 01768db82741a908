"""Text cleaning: phones, names, ids, flags and value corrections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values. They decide ids and stored values, so they must stay as they are.
STRIPPED = r"[ !-/:-@\[\]^_`{|}~]"  # space and ASCII punctuation, but not the backslash
RECRUITER_CORRECTIONS = {
    "Bruno Belbrook": "Bruno Bellbrook",
    "Fifi Etton": "Fifi Eton",
}
TRAINER_CORRECTIONS = {
    "Ely Kely": "Elly Kelly",
}
FLAG_VALUES = {"Yes": True, "No": False}
RESULT_VALUES = {"Pass": 1, "Fail": 0}


def clean_phone(c: Column) -> Column:
    """Drop brackets, turn spaces into dashes."""
    return F.translate(c, " ()", "-")


def slug(c: Column) -> Column:
    """Lower case without spaces and punctuation."""
    return F.lower(F.regexp_replace(c, STRIPPED, ""))


def person_id(date_text: Column, *names: Column) -> Column:
    """Slug of the names followed by the date text; null if any part is null."""
    return F.concat(slug(F.concat(*names)), date_text)


def upper_name(c: Column) -> Column:
    return F.upper(c)


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def trim_spaces(c: Column) -> Column:
    """Strip blanks only, as opposed to all white space."""
    return F.trim(c)


def _mapped(c: Column, values: Mapping) -> Column:
    out = None
    for key, value in values.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out


def yes_no(c: Column) -> Column:
    """Yes/No as boolean; anything else is null."""
    return _mapped(c, FLAG_VALUES)


def pass_fail(c: Column) -> Column:
    """Pass/Fail as 1/0; anything else is null."""
    return _mapped(c, RESULT_VALUES)


def correct_values(df: DataFrame, column: str, corrections: Mapping[str, str]) -> DataFrame:
    """Replace misspelt whole values of one column."""
    return df.replace(dict(corrections), subset=[column])


def course_code(course: Column) -> Column:
    """First three letters in upper case."""
    return F.upper(F.substring(course, 1, 3))


def behaviour_key(name: Column, date: Column) -> Column:
    """Name and ISO date joined, blanks as underscores; null if either is null."""
    return F.translate(F.concat(name, F.date_format(date, "yyyy-MM-dd")), " ", "_")


def trait_of(trait_week: Column) -> Column:
    return F.split(trait_week, "_")[0]


def week_of(trait_week: Column) -> Column:
    """Week number from names such as ``analytic_w3``."""
    return F.replace(F.get(F.split(trait_week, "_"), F.lit(1)), F.lit("w"), F.lit("")).try_cast("int")


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def prefixed_columns(df: DataFrame, prefixes: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]
