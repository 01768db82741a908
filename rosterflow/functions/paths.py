"""Facts kept in file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the raw files keep their keys.
JSON_KEY = r".*Talent/(.*?)\.json"
ACADEMY_FILE = r"Academy/(.+)_([^_/]*)_([^_/]*)\.csv$"


def source_path() -> Column:
    """Path of the file a row was read from, with URI escapes resolved."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def json_key_text(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, JSON_KEY, 1), F.lit(""))


def json_key(path: Column) -> Column:
    return json_key_text(path).try_cast("long")


def academy_course(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, ACADEMY_FILE, 1), F.lit(""))


def academy_date(path: Column) -> Column:
    return F.try_to_date(F.regexp_extract(path, ACADEMY_FILE, 3), "yyyy-MM-dd")
