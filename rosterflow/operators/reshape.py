"""Nested and wide data to long form and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.text import prefixed_columns, trait_of, week_of
from rosterflow.operators.joins import lookup
from rosterflow.operators.numbering import dense_ids

# The weekly marks of the academy files.
TRAITS = ("analytic", "determined", "imaginative", "independent", "professional", "studious")


def explode_array(df: DataFrame, keys: list[str], column: str, value: str) -> DataFrame:
    """One row per non-null element, with its place ``_at``; duplicates are kept."""
    return df.select(*keys, F.posexplode(column).alias("_at", value)).where(F.col(value).isNotNull())


def explode_map(df: DataFrame, keys: list[str], column: str, name: str, value: str) -> DataFrame:
    """One row per entry with a non-null value, with its place ``_at``."""
    return df.select(*keys, F.posexplode(column).alias("_at", name, value)).where(F.col(value).isNotNull())


def explode_dim(
    df: DataFrame, key: str, order: str, column: str, value: str, id_name: str, score: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Dimension (id, value) numbered from 0 by first appearance, and junction (key, id[, score]).

    ``column`` is an array, or a map when ``score`` names its values. Rows follow ``order``
    (unique), elements their place. The dimension needs only the first of equal elements in a
    row, so they are reduced inside the row, before any shuffle; the junction keeps them all.
    """
    keys = list(dict.fromkeys([key, order]))
    df = df.where(F.col(key).isNotNull())
    if score:
        long = firsts = explode_map(df, keys, column, value, score)
    else:
        long = explode_array(df, keys, column, value)
        firsts = explode_array(df.withColumn(column, F.array_distinct(column)), keys, column, value)
    dim = dense_ids(firsts, value, [order, "_at"], id_name, start=0, nulls="drop", unique=True)
    junction = lookup(long, dim, [value], "left").select(key, id_name, *([score] if score else []))
    return dim.select(id_name, value), junction


def unpivot_weeks(df: DataFrame, ids: list[str]) -> DataFrame:
    """Trait-by-week columns to rows (ids, trait, week, value); empty marks are left out."""
    columns = prefixed_columns(df, tuple(f"{t}_" for t in TRAITS))
    long = df.unpivot(ids, [F.col(c).cast("double").alias(c) for c in columns], "_trait_week", "value")
    return long.where(F.col("value").isNotNull()).select(
        *ids, trait_of(F.col("_trait_week")).alias("trait"), week_of(F.col("_trait_week")).alias("week"), "value"
    )


def pivot_traits(df: DataFrame, ids: list[str], column: str, value: str, names: tuple[str, ...]) -> DataFrame:
    """Rows to one column per name: mean of ``value`` per cell, groups with a null id left out.

    Conditional means share one aggregation and one shuffle; the names are known, so no extra
    job looks for them.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids])
    cells = [F.avg(F.when(F.col(column) == n, F.col(value))).alias(n) for n in names]
    return df.where(known & F.col(column).isin(*names)).groupBy(*ids).agg(*cells)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
