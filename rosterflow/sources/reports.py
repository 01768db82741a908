"""Assessment-day reports: date line, academy line, one ignored line, then one person per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions import report as R
from rosterflow.functions.dates import compact_date, free_text_date
from rosterflow.functions.text import person_id
from rosterflow.operators.joins import lookup
from rosterflow.session import stage
from rosterflow.sources.files import POSITION, file_reader, modified_after, with_file_position


def scan_report_lines(spark: SparkSession, raw_dir: str, since=None) -> DataFrame:
    """Lines with their position. Files are split like any text, not loaded whole."""
    scanned = file_reader(spark, ".txt", since).option("lineSep", "\n").text(f"{raw_dir}/Talent")
    lines = with_file_position(modified_after(scanned, since))
    return lines.withColumn("value", R.drop_returns(F.col("value")))


def parse_person(lines: DataFrame) -> DataFrame:
    """Names, scores, person id and the reason for a reject, from ``value`` and ``date``."""
    line = F.col("value")
    parsed = (
        lines.withColumn("first_name", R.first_name(line))
        .withColumn("last_name", R.last_name(line))
        .withColumn("psychometrics", R.psychometrics(line))
        .withColumn("presentation", R.presentation(line))
    )
    reason = (
        F.when(~R.has_dash(line), "no dash")
        .when(F.col("psychometrics").isNull() | F.col("presentation").isNull(), "no score")
        .when(F.col("date").isNull(), "no date")
    )
    key = person_id(compact_date(F.col("date")), F.col("first_name"), F.col("last_name"))
    return parsed.withColumn("assessment_id", key).withColumn("reject_reason", reason)


def parse_reports(lines: DataFrame) -> DataFrame:
    """Person lines with the date and academy of their file.

    The two heading lines are found by aggregation over the first split of each file; the
    ignored line and blank lines are left out.
    """
    staged = stage(lines, "report-lines")
    first = F.col("src_block") == 0
    # the row counter rises by one inside a split, so the heading lines are at the least count and the next
    opening = staged.where(first).groupBy("src_file").agg(F.min(F.struct("src_row", "value")).alias("_top"))
    opening = opening.select("src_file", F.col("_top.src_row").alias("_start"), F.col("_top.value").alias("date_text"))
    opening = stage(opening, "report-first")
    second = lookup(staged.where(first), opening.select("src_file", "_start"), ["src_file"], "inner").where(
        F.col("src_row") == F.col("_start") + 1
    )
    second = second.groupBy("src_file").agg(F.max("value").alias("academy_text"))
    heads = opening.join(second, "src_file", "left")
    heads = stage(heads, "report-heads")
    people = lookup(staged, heads, ["src_file"], "left").where(
        ~(first & (F.col("src_row") - F.col("_start") < 3)) & (F.trim("value") != "")
    )
    dated = people.withColumn("date", free_text_date(F.col("date_text"))).withColumn(
        "academy", R.first_word(F.col("academy_text"))
    )
    return parse_person(dated)


def read_assessment_reports(spark: SparkSession, raw_dir: str, since=None) -> tuple[DataFrame, DataFrame]:
    """(records, rejects)."""
    return split_rejects(stage(parse_reports(scan_report_lines(spark, raw_dir, since)), "reports"))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of parsed lines."""
    records = parsed.where(F.col("reject_reason").isNull()).select(
        "first_name", "last_name", "psychometrics", "presentation", "date", "academy", "assessment_id", *POSITION
    )
    rejects = parsed.where(F.col("reject_reason").isNotNull()).select(
        "src_file", F.col("value").alias("line"), "reject_reason"
    )
    return records, rejects
