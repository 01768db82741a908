"""Declared input schemas."""

from pyspark.sql import types as T

# Columns of the raw files.
APPLICANT_CSV = (
    "id",
    "name",
    "gender",
    "dob",
    "email",
    "city",
    "address",
    "postcode",
    "phone_number",
    "uni",
    "degree",
    "invited_date",
    "month",
    "invited_by",
)
TALENT_JSON = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("tech_self_score", T.MapType(T.StringType(), T.StringType())),
        T.StructField("strengths", T.ArrayType(T.StringType())),
        T.StructField("weaknesses", T.ArrayType(T.StringType())),
        T.StructField("self_development", T.StringType()),
        T.StructField("geo_flex", T.StringType()),
        T.StructField("financial_support_self", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("course_interest", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)
ACADEMY_FIXED = ("name", "trainer")

# CSV texts that stand for a missing value.
MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
