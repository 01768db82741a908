"""Checks of the rules a database would enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.operators.joins import lookup, orphans
from rosterflow.session import stage


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their share in percent per column, from one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot("_rows", df.columns, "column_name", "null_count")
    return long.select(
        "column_name",
        "null_count",
        (F.col("null_count") * 100 / F.nullif(F.col("_rows"), F.lit(0))).alias("null_percent"),
    )


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > 1).select(column)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose keys occur more than once (null keys are equal).

    Counts are combined map-side and only repeated keys are joined back, so a key with a third
    of the rows is never gathered in one window task.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    return lookup(df, stage(repeated, "repeated"), keys, "left_semi", null_safe=True)


def _violation(df: DataFrame, table: str, rule: str, column: str, count) -> DataFrame:
    return df.agg(count.cast("long").alias("violations")).select(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        F.coalesce("violations", F.lit(0)).cast("long").alias("violations"),
    )


def unique_audit(df: DataFrame, table: str, column: str, rule: str = "unique") -> DataFrame:
    """Number of values that occur more than once; nulls are not counted."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return _violation(counts, table, rule, column, F.count_if(F.col("_n") > 1))


def not_null_audit(df: DataFrame, table: str, columns: list[str], rule: str = "not_null") -> DataFrame:
    """Nulls per column, one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in columns])
    return _long(counts, table, rule, columns)


def length_audit(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Values longer than their column allows, one pass for all columns."""
    counts = df.agg(
        *[F.count_if(F.length(c) > n).cast("long").alias(c) for c, n in limits.items()]
    )
    return _long(counts, table, "length", list(limits))


def column_audit(df: DataFrame, table: str, missing: dict[str, list[str]], limits: dict[str, int]) -> DataFrame:
    """Nulls by rule and column, and values longer than allowed, from one pass over the table."""
    checks = [(rule, c, F.col(c).isNull()) for rule, columns in missing.items() for c in columns]
    checks += [("length", c, F.length(c) > n) for c, n in limits.items()]
    counts = df.agg(*[F.count_if(test).cast("long").alias(f"_{i}") for i, (_, _, test) in enumerate(checks)])
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), F.col(f"_{i}").alias("violations"))
        for i, (rule, column, _) in enumerate(checks)
    ]
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def key_audit(df: DataFrame, table: str, pk: str) -> DataFrame:
    """Primary key: not null and unique."""
    return not_null_audit(df, table, [pk], "pk_not_null").unionByName(
        unique_audit(df, table, pk, "pk_unique")
    )


def orphan_audit(child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Number of rows whose reference has no parent."""
    return _violation(orphans(child, fk, parent, pk), table, "fk", fk, F.count(F.lit(1)))


def code_collisions(df: DataFrame, code: str, value: str) -> DataFrame:
    """Codes shared by several values, with the number of values."""
    pairs = df.select(code, value).distinct()
    return pairs.groupBy(code).agg(F.count(value).alias("n_values")).where(F.col("n_values") > 1)


def _long(counts: DataFrame, table: str, rule: str, columns: list[str]) -> DataFrame:
    return counts.unpivot([], columns, "column_name", "violations").select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "column_name", "violations"
    )


def union_audits(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
