"""Talent records, their academies, strengths, weaknesses and languages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import pass_fail, yes_no
from rosterflow.operators.joins import attach_ids, outer_link
from rosterflow.operators.merge import collapse_first
from rosterflow.operators.numbering import dense_ids, first_positions
from rosterflow.operators.reshape import explode_dim
from rosterflow.session import stage

INTERVIEW = ["name", "self_development", "financial_support_self", "result", "course_interest", "geo_flex"]
ASSESSMENT = ["psychometrics", "presentation", "date", "academy"]
REPORT_POSITION = ["report_file", "report_block", "report_row"]
# records with a file come first, in listed order; then those known from reports only
ORDER = ["no_file", "key_text", *REPORT_POSITION]


def _sides(interviews: DataFrame, reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    left = interviews.select("person_id", "json_key", "key_text", *INTERVIEW)
    right = reports.select(
        F.col("assessment_id").alias("person_id"),
        *ASSESSMENT,
        F.col("src_file").alias("report_file"),
        F.col("src_block").alias("report_block"),
        F.col("src_row").alias("report_row"),
    )
    return left, right


def _typed(linked: DataFrame, academies: DataFrame) -> DataFrame:
    """Flags and results as values, academies as ids."""
    return attach_ids(linked, academies, "academy").select(
        "json_key",
        F.col("person_id").alias("applicant_id"),
        "name",
        "date",
        yes_no(F.col("self_development")).alias("self_development"),
        yes_no(F.col("financial_support_self")).alias("financial_support_self"),
        pass_fail(F.col("result")).alias("result"),
        "course_interest",
        F.col("psychometrics").alias("psychometric_result"),
        F.col("presentation").alias("presentation_result"),
        yes_no(F.col("geo_flex")).alias("geo_flex"),
        "academy_location_id",
        *ORDER,
    )


def _placed(linked: DataFrame) -> DataFrame:
    """Positions without nulls, so that records sort as documented at ``ORDER``."""
    return linked.withColumn("no_file", F.col("key_text").isNull().cast("int")).fillna(
        {"key_text": "", "report_file": "", "report_block": -1, "report_row": -1}
    )


def academy_ids(linked: DataFrame) -> DataFrame:
    """Academies by first appearance from 1; no academy is 0."""
    return dense_ids(linked, "academy", ORDER, "academy_location_id", start=1, nulls="zero")


def talent_tables(interviews: DataFrame, reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(talent, academy_locations) with one row per matching pair; both sides kept.

    The positions in ``ORDER`` stay with the talent rows.
    """
    left, right = _sides(interviews, reports)
    linked = stage(_placed(outer_link(left.dropDuplicates(), right, "person_id")), "talent-pairs")
    dim = academy_ids(linked)
    return _typed(linked, dim), dim.select("academy_location_id", F.col("academy").alias("location_name"))


def merged_talent(interviews: DataFrame, reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``talent_tables`` followed by the merge of records of one person, without the pairs.

    The first non-null value over all pairs of a person is the first non-null value of the side
    it comes from, so each side is merged before the join and the join is one to one. Flags
    are mapped before the merge, since an unknown value counts as missing.
    """
    left, right = _sides(interviews, reports)
    # an academy first appears with the first interview of its person, or in its report; one row
    # per person and one per person and academy are enough to tell, so no key is hot here
    first_interview = left.groupBy("person_id").agg(F.min("key_text").alias("key_text"))
    first_report = first_positions(right, ["person_id", "academy"], REPORT_POSITION)
    pairs_order = _placed(first_interview.join(first_report, "person_id", "full_outer"))
    dim = academy_ids(pairs_order)
    flagged = left.select(
        "person_id",
        "json_key",
        "key_text",
        "name",
        yes_no(F.col("self_development")).alias("self_development"),
        yes_no(F.col("financial_support_self")).alias("financial_support_self"),
        pass_fail(F.col("result")).alias("result"),
        "course_interest",
        yes_no(F.col("geo_flex")).alias("geo_flex"),
    )
    people = collapse_first(flagged, "person_id", ["key_text"])
    results = collapse_first(attach_ids(right, dim, "academy").drop("academy"), "person_id", REPORT_POSITION)
    none = F.lit(0).cast("long")
    talent = people.join(results, "person_id", "full_outer").select(
        F.col("person_id").alias("applicant_id"),
        "json_key",
        "name",
        "date",
        "self_development",
        "financial_support_self",
        "result",
        "course_interest",
        F.col("psychometrics").alias("psychometric_result"),
        F.col("presentation").alias("presentation_result"),
        "geo_flex",
        F.coalesce("academy_location_id", none).alias("academy_location_id"),
    )
    return talent, dim.select("academy_location_id", F.col("academy").alias("location_name"))


def strength_tables(interviews: DataFrame, column: str, value: str, id_name: str) -> tuple[DataFrame, DataFrame]:
    """(dimension, junction) of a list column, numbered from 0 in listed order."""
    return explode_dim(interviews, "json_key", "key_text", column, value, id_name)


def tech_tables(interviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(languages, scores), languages numbered from 0 in listed order."""
    return explode_dim(interviews, "json_key", "key_text", "tech_self_score", "tech_name", "tech_id", "score")
