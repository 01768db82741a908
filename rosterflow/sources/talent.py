"""Interview JSON files, one object per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.dates import compact_date, parse_dmy, repair_slashes
from rosterflow.functions.paths import json_key, json_key_text, source_path
from rosterflow.functions.text import person_id, yes_no
from rosterflow.operators.reshape import explode_array, explode_map
from rosterflow.session import stage
from rosterflow.sources.files import file_reader, modified_after
from rosterflow.sources.schemas import TALENT_JSON

FLAGS = ("self_development", "geo_flex", "financial_support_self")
NESTED = ("tech_self_score", "strengths", "weaknesses")


def scan_talent(spark: SparkSession, raw_dir: str, since=None) -> DataFrame:
    """All objects as read, broken ones with their text in ``_corrupt``."""
    objects = (
        file_reader(spark, ".json", since)
        .schema(TALENT_JSON)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(f"{raw_dir}/Talent")
    )
    return modified_after(objects, since).select("*", source_path().alias("src_file"))


def clean_talent(scanned: DataFrame) -> DataFrame:
    """Parsed date, person id and keys; ``key_text`` orders the files as they are listed."""
    date = parse_dmy(repair_slashes(F.col("date")))

    def whole(_: Column, score: Column) -> Column:
        return score.try_cast("double").try_cast("int")

    return (
        scanned.withColumn("tech_self_score", F.transform_values("tech_self_score", whole))
        .withColumn("key_text", json_key_text(F.col("src_file")))
        .withColumn("json_key", json_key(F.col("src_file")))
        .withColumn("date", date)
        .withColumn("person_id", person_id(compact_date(F.col("date")), F.col("name")))
    )


def read_talent_json(spark: SparkSession, raw_dir: str, since=None) -> tuple[DataFrame, DataFrame]:
    """(records, rejects). The files are read once and staged for all later uses.

    Rejects are unreadable objects, and the strengths, weaknesses and scores of objects whose file name holds no key.
    """
    return split_rejects(stage(clean_talent(scan_talent(spark, raw_dir, since)), "talent"))


def split_rejects(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of cleaned objects."""
    records = staged.where(F.col("_corrupt").isNull()).drop("_corrupt")
    broken = staged.where(F.col("_corrupt").isNotNull()).select(
        "src_file", F.col("_corrupt").alias("record"), F.lit("unreadable").alias("reason")
    )
    # such a record goes on under a new key; what hangs on its key cannot
    nested = records.where(F.col("json_key").isNull()).select(
        "src_file",
        F.to_json(F.struct(*NESTED)).alias("record"),
        F.lit("no whole number in the file name").alias("reason"),
    )
    return records, broken.unionByName(nested)


def shred_talent(records: DataFrame) -> dict[str, DataFrame]:
    """Core columns with flags as booleans, language scores, strengths and weaknesses, by ``json_key``."""
    keys = ["json_key", "key_text"]
    return {
        "core": records.drop(*NESTED).withColumns({c: yes_no(F.col(c)) for c in FLAGS}),
        "tech": explode_map(records, keys, "tech_self_score", "language", "score"),
        "strengths": explode_array(records, keys, "strengths", "strength"),
        "weaknesses": explode_array(records, keys, "weaknesses", "weakness"),
    }
