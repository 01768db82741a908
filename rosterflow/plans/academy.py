"""Trainees, their weekly marks, courses and trainers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import course_code
from rosterflow.operators.joins import attach_ids
from rosterflow.operators.numbering import dense_ids, number_rows
from rosterflow.operators.reshape import TRAITS, pivot_traits, unpivot_weeks
from rosterflow.sources.files import POSITION

FIXED = ["behaviour_id", "name", "trainer", "course_name", "date"]


def trainees(academy: DataFrame, order: list[str] = POSITION) -> tuple[DataFrame, DataFrame]:
    """(trainees with a row id and trainer_id, trainers). A missing trainer has an id of its own."""
    dim = dense_ids(academy, "trainer", order, "trainer_id", start=1, nulls="own")
    file_name = F.regexp_extract("src_file", "[^/]*$", 0).alias("file_name")
    people = number_rows(academy.select(*FIXED, file_name, *order), order, "trainee_id", 1)
    people = attach_ids(people, dim, "trainer").select(
        "trainee_id",
        "behaviour_id",
        "name",
        F.col("trainer_id").cast("string").alias("trainer_id"),
        course_code(F.col("course_name")).alias("course_id"),
        "course_name",
        "date",
        "file_name",
    )
    return people, dim.select(F.col("trainer_id").cast("string").alias("trainer_id"), "trainer")


def courses(academy: DataFrame) -> DataFrame:
    return academy.select(course_code(F.col("course_name")).alias("course_id"), "course_name").distinct()


def behaviours(academy: DataFrame) -> DataFrame:
    """One row per trainee and week with six marks; weeks without any mark are left out."""
    return behaviour_rows(unpivot_weeks(academy, FIXED))


def behaviour_rows(marks: DataFrame) -> DataFrame:
    cells = pivot_traits(marks, [*FIXED, "week"], "trait", "value", TRAITS)
    return cells.select("behaviour_id", "name", "week", *[F.col(t).cast("int").alias(t) for t in TRAITS])


def academy_tables(academy: DataFrame, order: list[str] = POSITION) -> dict[str, DataFrame]:
    people, trainers = trainees(academy, order)
    return {
        "courses": courses(academy),
        "trainers": trainers,
        "trainees": people,
        "behaviours": behaviours(academy),
    }
