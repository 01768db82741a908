"""One person across applicants, talent and trainees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.operators.linking import apply_links, link_forward
from rosterflow.operators.merge import collapse_repeated
from rosterflow.session import stage_packed


def link_applicants(
    talent: DataFrame, applicants: DataFrame, order: list[str], target: str = "applicant_id"
) -> DataFrame:
    """Talent records with the id of the applicant of that name invited last before their date.

    ``talent`` is unique on ``applicant_id``; the linked id is written to ``target``.
    """
    left = applicants.select(
        F.lower("name").alias("name_key"),
        F.col("invited_date").alias("date"),
        F.struct(*order).alias("_applicant_at"),
        F.col("applicant_id").alias("linked_id"),
    )
    right = talent.select(F.lower("name").alias("name_key"), "date", "applicant_id")
    links = link_forward(
        left, right, ["name_key"], "date", "_applicant_at", "applicant_id", "linked_id", "right_wild"
    )
    linked = apply_links(talent.withColumn("_new", F.col("applicant_id")), links, "applicant_id", "linked_id", "_new")
    if target == "applicant_id":
        linked = linked.drop("applicant_id")
    return linked.withColumnRenamed("_new", target)


def link_trainees(
    trainees: DataFrame, talent: DataFrame, order: str, null_rule: str = "left_wild"
) -> DataFrame:
    """Trainees with the ``json_key`` of the talent record of that name and course.

    ``trainees`` is unique on ``trainee_id``; null-dated talent matches any course start unless
    ``null_rule`` is "exclude".
    """
    left = talent.select("name", F.col("course_interest").alias("course_name"), "date", order, "json_key")
    right = trainees.select("name", "course_name", "date", "trainee_id")
    links = link_forward(
        left, right, ["name", "course_name"], "date", order, "trainee_id", "json_key", null_rule
    )
    return apply_links(trainees, links, "trainee_id", "json_key", "json_key")


def linked_records(
    talent: DataFrame, applicants: DataFrame, trainees: DataFrame, order: list[str]
) -> tuple[DataFrame, DataFrame]:
    """(talent merged under its final applicant ids, trainees with ``json_key``).

    ``talent`` holds one record per ``applicant_id``. Records that end up under one applicant
    are merged in the order of their former ids.
    """
    moved = stage_packed(link_applicants(talent, applicants, order, "final_id"), "linked")
    followed = link_trainees(trainees, moved, "applicant_id")
    merged = collapse_repeated(moved, "final_id", ["applicant_id"]).withColumnRenamed("final_id", "applicant_id")
    return merged, followed
