"""Academy CSV files, whose weekly columns differ from file to file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.paths import academy_course, academy_date
from rosterflow.functions.text import TRAINER_CORRECTIONS, behaviour_key, correct_values
from rosterflow.operators.reshape import TRAITS
from rosterflow.session import stage
from rosterflow.sources.delimited import column, read_delimited, scan_lines
from rosterflow.sources.files import POSITION
from rosterflow.sources.schemas import ACADEMY_FIXED

_WEEKLY = rf"^({'|'.join(TRAITS)})_w\d+$"


def scan_academy(spark: SparkSession, raw_dir: str, since=None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of all files."""
    return academy_rows(scan_lines(spark, f"{raw_dir}/Academy", since))


def academy_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of staged CSV lines, whatever weeks the files hold and in whatever order.

    The driver sees the distinct names of weekly columns, whose number is that of traits and weeks. A mark that is not a
    number is null.
    """
    records, rejects = read_delimited(lines, list(ACADEMY_FIXED), "academy")
    names = records.select(F.explode("heading").alias("name")).distinct().where(F.col("name").rlike(_WEEKLY)).collect()
    weekly = sorted({r["name"] for r in names} or {f"{t}_w1" for t in TRAITS})
    marks = [column(n).try_cast("double").alias(n) for n in weekly]
    return records.select(*[column(n).alias(n) for n in ACADEMY_FIXED], *marks, *POSITION), rejects


def clean_academy(scanned: DataFrame) -> DataFrame:
    """Course and date from the file name, corrected trainers, behaviour id."""
    named = scanned.withColumn("course_name", academy_course(F.col("src_file"))).withColumn(
        "date", academy_date(F.col("src_file"))
    )
    fixed = correct_values(named, "trainer", TRAINER_CORRECTIONS)
    return fixed.withColumn("behaviour_id", behaviour_key(F.col("name"), F.col("date")))


def read_academy(spark: SparkSession, raw_dir: str, since=None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects)."""
    rows, rejects = scan_academy(spark, raw_dir, since)
    return stage(clean_academy(rows), "academy"), rejects


