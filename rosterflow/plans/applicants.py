"""Applicants, recruiters and locations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.text import RECRUITER_CORRECTIONS, correct_values
from rosterflow.operators.joins import attach_ids, fits_broadcast
from rosterflow.operators.numbering import dense_ids, first_positions, number_rows, row_ids
from rosterflow.session import stage
from rosterflow.sources.applicants import read_applicants

PLACE = ["address", "postcode", "city", "applicant_id"]
ORDER = ["src_file", "id"]


def recruit(applicants: DataFrame, order: list[str] = ORDER) -> tuple[DataFrame, DataFrame]:
    """(applicants with recruiter_id, recruiters). A missing recruiter has an id of its own."""
    fixed = correct_values(applicants, "invited_by", RECRUITER_CORRECTIONS)
    dim = dense_ids(fixed, "invited_by", order, "recruiter_id", start=1, nulls="own")
    recruiters = dim.select("recruiter_id", F.col("invited_by").alias("recruiter_name"))
    return attach_ids(fixed, dim, "invited_by"), recruiters


def locations(applicants: DataFrame, order: list[str] = ORDER) -> DataFrame:
    """Distinct places per applicant, numbered from 0."""
    return row_ids(applicants, PLACE, order, "location_id").select("location_id", *PLACE)


def applicant_tables(applicants: DataFrame, order: list[str] = ORDER) -> dict[str, DataFrame]:
    """applicants, location and recruiters; ``order`` stays with the applicants."""
    linked, recruiters = recruit(applicants, order)
    return {
        "applicants": linked.drop("address", "postcode", "city", "invited_by"),
        "location": locations(applicants, order),
        "recruiters": recruiters,
    }


def continue_ids(
    new: DataFrame, known: DataFrame, values: list[str], order: list[str], name: str, start: int
) -> DataFrame:
    """Ids for values ``known`` lacks, counting on from its largest id (``start`` if empty)."""
    firsts = first_positions(new, values, order)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in values]
    right = known.select(*values)
    right = F.broadcast(right) if fits_broadcast(right) else right
    unseen = firsts.alias("a").join(right.alias("b"), same, "left_anti")
    top = known.agg(F.max(name)).first()[0]
    return number_rows(unseen, order, name, start if top is None else top + 1).select(*values, name)


def applicants_since(
    spark: SparkSession,
    raw_dir: str,
    since,
    current: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Tables of the files modified after ``since``, and what could not be read as ``rejects``; empty frames when there
    are none.

    ``current`` holds the stored ``recruiters`` and ``location``. Ids they already gave stay,
    and only new recruiters and places are returned.
    """
    applicants, rejects = read_applicants(spark, raw_dir, since)
    return {**continue_applicants(applicants, current), "rejects": rejects}


def continue_applicants(
    applicants: DataFrame, current: dict[str, DataFrame] | None = None, order: list[str] = ORDER
) -> dict[str, DataFrame]:
    if not current:
        return applicant_tables(applicants, order)
    fixed = correct_values(applicants, "invited_by", RECRUITER_CORRECTIONS)
    known = current["recruiters"].withColumnRenamed("recruiter_name", "invited_by")
    added = continue_ids(fixed, known, ["invited_by"], order, "recruiter_id", 1)
    everyone = known.select("invited_by", "recruiter_id").unionByName(added)
    places = continue_ids(fixed, current["location"], PLACE, order, "location_id", 0)
    return {
        "applicants": attach_ids(fixed, everyone, "invited_by").drop("address", "postcode", "city", "invited_by"),
        "location": places.select("location_id", *PLACE),
        "recruiters": added.select("recruiter_id", F.col("invited_by").alias("recruiter_name")),
    }
