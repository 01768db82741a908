"""The fifteen tables: build, refresh and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.operators import audit as A
from rosterflow.operators.joins import keep_members, surrogate_join
from rosterflow.operators.numbering import SYNTHETIC_BASE, number_rows
from rosterflow.operators.reshape import TRAITS
from rosterflow.plans import academy as academy_plan
from rosterflow.plans.appending import ledger
from rosterflow.plans.applicants import ORDER, applicant_tables
from rosterflow.plans.linked import linked_records
from rosterflow.plans.talent import merged_talent, strength_tables, tech_tables
from rosterflow.session import stage_packed, together
from rosterflow.sources.academy import read_academy
from rosterflow.sources.applicants import read_applicants
from rosterflow.sources.files import POSITION
from rosterflow.sources.reports import read_assessment_reports
from rosterflow.sources.talent import read_talent_json

# The table contract. Parents stand before their children.
COLUMNS = {
    "recruiters": ["recruiter_id", "recruiter_name"],
    "applicants": [
        "applicant_id",
        "name",
        "gender",
        "dob",
        "email",
        "phone_number",
        "uni",
        "degree",
        "invited_date",
        "recruiter_id",
    ],
    "academy_locations": ["academy_location_id", "location_name"],
    "talent": [
        "talent_id",
        "json_key",
        "applicant_id",
        "date",
        "self_development",
        "financial_support_self",
        "result",
        "course_interest",
        "psychometric_result",
        "presentation_result",
        "geo_flex",
        "academy_location_id",
    ],
    "strengths": ["strength_id", "strength"],
    "weaknesses": ["weakness_id", "weakness"],
    "tech_self_scores": ["tech_id", "tech_name"],
    "strengths_junction": ["json_key", "strength_id"],
    "weaknesses_junction": ["json_key", "weakness_id"],
    "tech_junction": ["tech_id", "json_key", "score"],
    "location": ["location_id", "applicant_id", "address", "postcode", "city"],
    "courses": ["course_id", "course_name"],
    "trainers": ["trainer_id", "trainer"],
    "trainees": ["trainee_id", "json_key", "trainer_id", "course_id", "date"],
    "behaviours": [
        "behaviour_id",
        "trainee_id",
        "week_number",
        "analytic",
        "independent",
        "imaginative",
        "studious",
        "professional",
        "determined",
    ],
}
PRIMARY_KEYS = {
    "recruiters": "recruiter_id",
    "applicants": "applicant_id",
    "location": "location_id",
    "academy_locations": "academy_location_id",
    "talent": "talent_id",
    "strengths": "strength_id",
    "weaknesses": "weakness_id",
    "tech_self_scores": "tech_id",
    "trainers": "trainer_id",
    "courses": "course_id",
    "trainees": "trainee_id",
    "behaviours": "behaviour_id",
}
UNIQUE = [
    ("talent", "json_key"),
    ("talent", "applicant_id"),
    ("strengths", "strength"),
    ("weaknesses", "weakness"),
    ("tech_self_scores", "tech_name"),
    ("trainers", "trainer"),
    ("trainees", "json_key"),
]
FOREIGN_KEYS = [
    ("applicants", "recruiter_id", "recruiters", "recruiter_id"),
    ("location", "applicant_id", "applicants", "applicant_id"),
    ("talent", "applicant_id", "applicants", "applicant_id"),
    ("talent", "academy_location_id", "academy_locations", "academy_location_id"),
    ("strengths_junction", "json_key", "talent", "json_key"),
    ("strengths_junction", "strength_id", "strengths", "strength_id"),
    ("weaknesses_junction", "json_key", "talent", "json_key"),
    ("tech_junction", "tech_id", "tech_self_scores", "tech_id"),
    ("tech_junction", "json_key", "talent", "json_key"),
    ("trainees", "json_key", "talent", "json_key"),
    ("trainees", "trainer_id", "trainers", "trainer_id"),
    ("trainees", "course_id", "courses", "course_id"),
    ("behaviours", "trainee_id", "trainees", "trainee_id"),
]
NOT_NULL = {
    "strengths": ["strength"],
    "weaknesses": ["weakness"],
    "tech_self_scores": ["tech_name"],
    "tech_junction": ["score"],
    "trainers": ["trainer"],
    "courses": ["course_name"],
    "trainees": ["trainer_id", "course_id"],
    "behaviours": ["week_number"],
}
LENGTHS = {
    "applicants": {"applicant_id": 50},
    "location": {"applicant_id": 50},
    "talent": {"applicant_id": 50},
    "strengths": {"strength": 30},
    "weaknesses": {"weakness": 30},
    "tech_self_scores": {"tech_name": 50},
    "trainers": {"trainer_id": 30, "trainer": 50},
    "courses": {"course_id": 30},
    "trainees": {"trainer_id": 30, "course_id": 30},
}


def assemble_star(
    applicants: DataFrame,
    interviews: DataFrame,
    reports: DataFrame,
    academy: DataFrame,
    applicant_order: list[str] = ORDER,
    academy_order: list[str] = POSITION,
    skip: int = 0,
    keep: bool = False,
) -> dict[str, DataFrame]:
    """All tables from cleaned, staged sources; ``skip`` leaves out the first keyless talent.

    ``keep`` adds the ledger (see ``plans.appending``) that a later load needs to be added to them.
    """
    spark = applicants.sparkSession

    def merged() -> tuple[DataFrame, DataFrame]:
        records, locations = merged_talent(interviews, reports)
        return stage_packed(records, "merged"), locations

    def schooled() -> tuple[dict[str, DataFrame], DataFrame]:
        tables = academy_plan.academy_tables(academy, academy_order)
        return tables, stage_packed(tables["trainees"], "trainees")

    people, (records, academies), (school, roster), strength, weakness, tech = together(
        spark,
        lambda: applicant_tables(applicants, applicant_order),
        merged,
        schooled,
        lambda: strength_tables(interviews, "strengths", "strength", "strength_id"),
        lambda: strength_tables(interviews, "weaknesses", "weakness", "weakness_id"),
        lambda: tech_tables(interviews),
    )
    talent, trainees = linked_records(records, applicants, roster, applicant_order)
    talent, trainees = together(
        spark, lambda: stage_packed(talent, "talent-final"), lambda: stage_packed(trainees, "trainees-linked")
    )
    (strengths, strength_pairs), (weaknesses, weakness_pairs), (languages, scores) = strength, weakness, tech
    stored, marks, strength_kept, weakness_kept, scores_kept = together(
        spark,
        lambda: _stored_talent(talent, skip),
        lambda: _stored_marks(school["behaviours"], trainees),
        lambda: keep_members(strength_pairs, talent, "json_key"),
        lambda: keep_members(weakness_pairs, talent, "json_key"),
        lambda: keep_members(scores, talent, "json_key"),
    )

    tables = {
        **people,
        "academy_locations": academies,
        "talent": stored,
        "strengths": strengths,
        "weaknesses": weaknesses,
        "tech_self_scores": languages,
        "strengths_junction": strength_kept,
        "weaknesses_junction": weakness_kept,
        "tech_junction": scores_kept,
        "courses": school["courses"],
        "trainers": school["trainers"],
        # the load stores trainees without their date
        "trainees": trainees.withColumn("date", F.lit(None).cast("date")),
        "behaviours": marks,
    }
    star = {name: tables[name].select(*columns) for name, columns in COLUMNS.items()}
    if keep:
        pairs = {"strengths_junction": strength_pairs, "weaknesses_junction": weakness_pairs, "tech_junction": scores}
        pairs = {name: df.select(*COLUMNS[name]) for name, df in pairs.items()}
        star |= ledger(records, applicants, applicant_order, roster, talent, pairs)
    return star


def _stored_talent(talent: DataFrame, skip: int) -> DataFrame:
    """Records with a file are stored first, then those that get a key here; the first ``skip`` of these are left out.

    One numbering gives both ids: the made keys count the rows behind the last record with a file.
    """
    flagged = talent.withColumn("no_file", F.col("json_key").isNull().cast("int"))
    placed = number_rows(flagged, ["no_file", "applicant_id"], "_place")
    late = F.col("_place") - F.lit(talent.where(F.col("json_key").isNotNull()).count())
    keyless = F.col("no_file") == 1
    rows = placed.withColumn("talent_id", F.col("_place") + 1 - F.when(keyless, skip).otherwise(0))
    rows = rows.withColumn("json_key", F.coalesce("json_key", late + SYNTHETIC_BASE).cast("long"))
    return rows.where(~keyless | (late >= skip)).drop("_place")


def _stored_marks(behaviours: DataFrame, trainees: DataFrame) -> DataFrame:
    """Marks under their trainee's id.

    A name can stand in two files of one date, so the order goes on to the marks themselves.
    """
    marks = surrogate_join(behaviours, trainees, "behaviour_id", "trainee_id")
    marks = marks.drop("name").withColumnRenamed("week", "week_number")
    return number_rows(marks, ["trainee_id", "week_number", *TRAITS], "behaviour_id", 1)


def build_star(spark: SparkSession, raw_dir: str, skip: int = 0) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables, rejects) of a full refresh from the raw files. Each source is read once and staged.

    The tables come with the ledger, so that what is written of them can be added to. ``rejects`` (source, src_file, record, reason) holds all that was read and could not be used.
    """
    (interviews, objects), (reports, lines), (applicants, people), (academy, marks) = together(
        spark,
        lambda: read_talent_json(spark, raw_dir),
        lambda: read_assessment_reports(spark, raw_dir),
        lambda: read_applicants(spark, raw_dir),
        lambda: read_academy(spark, raw_dir),
    )
    tables = assemble_star(applicants, interviews, reports, academy, skip=skip, keep=True)
    return tables, load_rejects(objects, lines, people, marks)


def load_rejects(objects: DataFrame, lines: DataFrame, people: DataFrame, marks: DataFrame) -> DataFrame:
    """What the four readers could not use, as one table."""
    named = objects.select(F.lit("talent").alias("source"), "src_file", "record", "reason")
    spoken = lines.select(
        F.lit("reports").alias("source"),
        "src_file",
        F.col("line").alias("record"),
        F.col("reject_reason").alias("reason"),
    )
    return named.unionByName(spoken).unionByName(people).unionByName(marks)


def audit_star(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations per rule (table_name, rule, column_name, violations); expected to be zero."""
    parts = []
    for name in COLUMNS:
        keys = [PRIMARY_KEYS[name]] if name in PRIMARY_KEYS else []
        missing = {"pk_not_null": keys, "not_null": NOT_NULL.get(name, [])}
        if any(missing.values()) or name in LENGTHS:
            parts.append(A.column_audit(tables[name], name, missing, LENGTHS.get(name, {})))
        parts += [A.unique_audit(tables[name], name, key, "pk_unique") for key in keys]
    parts += [A.unique_audit(tables[t], t, c) for t, c in UNIQUE]
    parts += [A.orphan_audit(tables[c], c, fk, tables[p], pk) for c, fk, p, pk in FOREIGN_KEYS]
    return A.union_audits(parts)


def unlinked_trainees(tables: dict[str, DataFrame]) -> DataFrame:
    """Trainees no talent record was linked to."""
    return tables["trainees"].where(F.col("json_key").isNull())


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return A.union_audits(counts)
