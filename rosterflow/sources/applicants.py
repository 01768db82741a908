"""Applicant CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.dates import invite_date, parse_dmy
from rosterflow.functions.text import clean_phone, person_id
from rosterflow.operators.merge import fill_previous_date
from rosterflow.session import stage
from rosterflow.sources.delimited import column, read_delimited, scan_lines
from rosterflow.sources.schemas import APPLICANT_CSV


def applicant_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of staged CSV lines, columns by heading; ``id`` is the row number in its file.

    A file needs ``id`` and ``name``; other columns it lacks are null. A row without whole number as id is rejected.
    """
    records, rejects = read_delimited(lines, ["id", "name"], "applicants")
    number = column("id").try_cast("double").try_cast("int")
    numberless = records.where(number.isNull()).select(
        F.lit("applicants").alias("source"),
        "src_file",
        F.array_join("fields", ",", "").alias("record"),
        F.lit("no whole number as id").alias("reason"),
    )
    texts = [column(c).alias(c) for c in APPLICANT_CSV[1:]]
    rows = records.select(number.alias("id"), *texts, "src_file").where("id IS NOT NULL")
    return rows, rejects.unionByName(numberless)


def scan_applicants(spark: SparkSession, raw_dir: str, since=None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of all files."""
    return applicant_rows(scan_lines(spark, f"{raw_dir}/Talent", since))


def clean_applicants(raw: DataFrame) -> DataFrame:
    """Cleaned rows with ``applicant_id``; (src_file, id) stays as their position.

    Rows with a value the cleaning cannot use are kept and flagged, not a reason to stop.
    """
    cleaned = (
        raw.withColumn("phone_number", clean_phone(F.col("phone_number")))
        .withColumn("birth", parse_dmy(F.col("dob")))
        .withColumn("invited_on", invite_date(F.col("invited_date"), F.col("month")))
    )
    filled = fill_previous_date(cleaned, ["src_file"], "id", "invited_on")
    return filled.select(
        "src_file",
        "id",
        person_id(F.col("iddate"), F.col("name")).alias("applicant_id"),
        "name",
        "gender",
        F.col("birth").alias("dob"),
        "email",
        "city",
        "address",
        "postcode",
        "phone_number",
        "uni",
        "degree",
        F.col("invited_on").alias("invited_date"),
        "invited_by",
        "iddate",
        "date_missing",
        (F.col("invited_date").isNull() & F.col("month").isNotNull()).alias("day_missing"),
        (F.col("birth").isNull() & F.col("dob").isNotNull()).alias("dob_unreadable"),
    )


def read_applicants(spark: SparkSession, raw_dir: str, since=None) -> tuple[DataFrame, DataFrame]:
    """(applicants, rejects)."""
    rows, rejects = scan_applicants(spark, raw_dir, since)
    return stage(clean_applicants(rows), "applicants"), rejects
