"""The generated test tables in the roles of the raw sources.

Orders with their customers stand for people on dates: status F for invited applicants, O for
interviewed talent, P for trainees; O and P orders also for assessed people. Missing values are
made by rules on the order key, so that an oracle can state them too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.dates import compact_date
from rosterflow.functions.text import TRAINER_CORRECTIONS, behaviour_key, correct_values, person_id
from rosterflow.operators.joins import bounded_join
from rosterflow.operators.merge import fill_previous_date
from rosterflow.operators.reshape import TRAITS
from rosterflow.session import stage
from rosterflow.sources.reports import parse_person


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def null_if(condition: str, column: str):
    return F.expr(f"CASE WHEN {condition} THEN NULL ELSE {column} END")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer and nation: k, st, d, pr, name, seg, place, nk."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_custkey", "o_orderstatus AS st", "CAST(o_orderdate AS DATE) AS d", "o_orderpriority AS pr"
    )
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS o_custkey", "replace(c_name, '#', ' #') AS name", "c_mktsegment AS seg", "c_nationkey AS nk"
    )
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS nk", "n_name AS place")
    return bounded_join(orders, customer, ["o_custkey"]).join(nation, "nk").drop("o_custkey")


def applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people(spark, sf_dir).where("st = 'F'").select(
        F.concat("pr", F.lit(".csv")).alias("src_file"),
        F.col("k").alias("id"),
        "name",
        F.lit(None).cast("string").alias("gender"),
        F.lit(None).cast("date").alias("dob"),
        F.lit(None).cast("string").alias("email"),
        F.col("pr").alias("city"),
        F.col("place").alias("address"),
        F.col("nk").cast("string").alias("postcode"),
        F.lit(None).cast("string").alias("phone_number"),
        F.col("seg").alias("uni"),
        F.lit(None).cast("string").alias("degree"),
        null_if("k % 7 = 0", "d").alias("invited_date"),
        F.expr(
            "CASE WHEN k % 11 = 0 THEN NULL WHEN k % 5 = 0 THEN 'Fifi Etton' ELSE concat('Rec ', seg) END"
        ).alias("invited_by"),
    )
    filled = fill_previous_date(rows, ["src_file"], "id", "invited_date")
    return filled.withColumn("applicant_id", person_id(F.col("iddate"), F.col("name")))


def interviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = people(spark, sf_dir).where("st = 'O'").select(
        F.col("k").alias("json_key"),
        F.col("k").cast("string").alias("key_text"),
        F.expr("CASE WHEN k % 4 = 0 THEN upper(name) ELSE name END").alias("name"),
        null_if("k % 17 = 0", "d").alias("date"),
        F.expr("CASE k % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Maybe' END").alias("self_development"),
        F.expr("CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'No' ELSE 'Yes' END").alias("financial_support_self"),
        F.expr("CASE k % 4 WHEN 0 THEN 'Pass' WHEN 1 THEN 'Fail' END").alias("result"),
        F.expr("CASE WHEN k % 2 = 0 THEN 'Yes' ELSE 'No' END").alias("geo_flex"),
        F.col("seg").alias("course_interest"),
        F.expr("array(pr, seg, CAST(NULL AS STRING), pr)").alias("strengths"),
        F.expr("CASE WHEN k % 6 = 0 THEN array() ELSE array(place, seg) END").alias("weaknesses"),
        F.expr("map(seg, CAST(k % 10 AS INT), pr, CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(k % 7 AS INT) END)").alias(
            "tech_self_score"
        ),
    )
    return rows.withColumn("person_id", person_id(compact_date(F.col("date")), F.col("name")))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person lines as a report holds them; every third person's name differs from the interview's,
    some lines lack the dash or the scores."""
    line = """concat(
        upper(name), CASE WHEN k % 3 = 0 THEN '-X,' ELSE '' END,
        CASE WHEN k % 23 = 0 THEN '' ELSE ' - ' END, ' Psychometrics: ',
        CASE WHEN k % 29 = 0 THEN 'none' ELSE concat(k % 101, '/100') END,
        ', Presentation: ', k % 33, '/32')"""
    return people(spark, sf_dir).where("st IN ('O', 'P')").select(
        F.expr(line).alias("value"),
        F.col("d").alias("date"),
        F.col("place").alias("academy"),
        F.concat("pr", F.lit(".txt")).alias("src_file"),
        F.lit(0).cast("long").alias("src_block"),
        F.col("k").alias("src_row"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = stage(parse_person(report_lines(spark, sf_dir)), "reports")
    return parsed.where(F.col("reject_reason").isNull())


def academy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide weekly marks: trait t of week w is (k + t + w) mod 9, the second week partly missing."""
    marks = [
        F.expr(f"CAST((k + {i} + {w}) % 9 AS DOUBLE)" if w == 1 else
               f"CASE WHEN k % 4 = 0 OR (k % 6 = 0 AND {i} = 2) THEN NULL ELSE CAST((k + {i} + {w}) % 9 AS DOUBLE) END")
        .alias(f"{t}_w{w}")
        for w in (1, 2)
        for i, t in enumerate(TRAITS)
    ]
    rows = people(spark, sf_dir).where("st = 'P'").select(
        "name",
        F.expr(
            "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 5 = 0 THEN 'Ely Kely' ELSE concat('Trainer ', pr) END"
        ).alias("trainer"),
        F.col("seg").alias("course_name"),
        null_if("k % 19 = 0", "d").alias("date"),
        F.concat("seg", F.lit(".csv")).alias("src_file"),
        F.lit(0).cast("long").alias("src_block"),
        F.col("k").alias("src_row"),
        *marks,
    )
    fixed = correct_values(rows, "trainer", TRAINER_CORRECTIONS)
    return fixed.withColumn("behaviour_id", behaviour_key(F.col("name"), F.col("date")))
