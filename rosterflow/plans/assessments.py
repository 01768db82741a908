"""Assessment results and the extracts that join them to interviews by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import full_name
from rosterflow.operators.joins import attach_ids, lookup, name_join
from rosterflow.operators.numbering import dense_ids
from rosterflow.operators.reshape import explode_map
from rosterflow.session import stage

EXTRACT = [
    "json_key",
    "name",
    "date",
    "self_development",
    "financial_support_self",
    "result",
    "course_interest",
    "geo_flex",
]


def assessment_table(reports: DataFrame) -> DataFrame:
    return reports.select(
        "first_name", "last_name", "psychometrics", "presentation", "date", "academy", "assessment_id"
    )


def _results(reports: DataFrame) -> DataFrame:
    """Reports under the upper-case name they are joined by, with their places."""
    return reports.select(
        full_name(F.col("first_name"), F.col("last_name")).alias("report_name"),
        "psychometrics",
        "presentation",
        "academy",
        "assessment_id",
        F.col("src_file").alias("report_file"),
        F.col("src_block").alias("report_block"),
        F.col("src_row").alias("report_row"),
    ).where(F.col("report_name").isNotNull())


def interview_results(interviews: DataFrame, reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(results, academies): interviews with the assessments of the same upper-case name.

    Academies are numbered from 0 by first appearance, a missing one is -1.
    """
    results = stage(_results(reports), "extract-results")
    # of all pairs of a name, an academy's first has the first interview and the academy's first report
    place = ["report_file", "report_block", "report_row"]
    people = interviews.groupBy(F.upper("name").alias("_name")).agg(F.min("key_text").alias("key_text"))
    firsts = results.groupBy("report_name", "academy").agg(F.min(F.struct(*place)).alias("_at"))
    firsts = name_join(people, firsts, F.col("_name"), F.col("report_name")).select("academy", "key_text", "_at.*")
    dim = dense_ids(firsts, "academy", ["key_text", *place], "academyid", start=0, nulls="zero")
    dim = stage(dim, "extract-academies")
    coded = attach_ids(results, dim, "academy")
    pairs = name_join(interviews.select(*EXTRACT), coded, F.col("name"), F.col("report_name"))
    found = pairs.withColumn("name", F.upper("name")).select(
        *EXTRACT, "psychometrics", "presentation", "assessment_id", "academyid"
    )
    return found, dim.select("academy", "academyid")


def tech_by_assessment(interviews: DataFrame, reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scores, languages): language scores per assessment, joined by upper-case name.

    Languages are numbered from 0 in the order of assessment ids.
    """
    results = stage(_results(reports).where(F.col("assessment_id").isNotNull()), "extract-assessments")
    long = explode_map(interviews, ["name", "key_text"], "tech_self_score", "language", "score")
    long = stage(long, "extract-scores")
    # of all pairs of a name, a language's first has the least assessment and the first interview with the language
    tests = results.groupBy("report_name").agg(
        F.min(F.struct("assessment_id", "report_file", "report_block", "report_row")).alias("_test")
    )
    entry = F.min(F.struct("key_text", "_at")).alias("_entry")
    firsts = long.groupBy(F.upper("name").alias("_name"), "language").agg(entry)
    firsts = name_join(firsts, tests, F.col("_name"), F.col("report_name")).select("language", "_test.*", "_entry.*")
    order = ["assessment_id", "key_text", "report_file", "report_block", "report_row", "_at"]
    dim = stage(dense_ids(firsts, "language", order, "language_id", start=0, nulls="drop"), "extract-languages")
    coded = lookup(long, dim, ["language"], "left")
    pairs = name_join(coded, results.select("report_name", "assessment_id"), F.col("name"), F.col("report_name"))
    scores = pairs.select(F.col("assessment_id").alias("applicationid"), "language_id", "score")
    return scores, dim.select("language", "language_id")
