"""Merging of records that describe the same person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.dates import NO_DATE, compact_date, month_only
from rosterflow.operators.joins import equi_join, fits_broadcast
from rosterflow.operators.numbering import carry_forward
from rosterflow.session import stage_packed


def collapse_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key; each column takes its first non-null value in ``order``.

    Rows without key are left out. The aggregation is combined map-side, so a key with many
    copies leaves each task as one row.
    """
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    columns = [c for c in df.columns if c != key and c not in order]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), position)).alias(c) for c in columns])
    )


def collapse_repeated(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """As ``collapse_first``, for a written table in which few keys repeat: only their rows are merged, the others stay.

    Keys are counted without the columns. If those that repeat are too many to be broadcast, all rows are merged.
    """
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = stage_packed(repeated.where("_n > 1").select(key), "repeated")
    if not fits_broadcast(repeated):
        return collapse_first(df, key, order)
    columns = [key, *[c for c in df.columns if c != key and c not in order]]
    known, repeated = df.where(F.col(key).isNotNull()), F.broadcast(repeated)
    alone = equi_join(known, repeated, [key], "left_anti", False).select(*columns)
    several = equi_join(known, repeated, [key], "left_semi", False)
    return alone.unionByName(collapse_first(several, key, order))


def fill_previous_date(
    df: DataFrame, parts: list[str], order: str, date: str, name: str = "iddate", flag: str = "date_missing"
) -> DataFrame:
    """Id date text: own date as yyyyMMdd, else the previous dated row's yyyyMM00.

    Rows before the first dated row of their file get 00000000. ``flag`` marks those.
    """
    carried = carry_forward(df, parts, order, date, "_previous")
    text = F.coalesce(compact_date(F.col(date)), month_only(F.col("_previous")), F.lit(NO_DATE))
    return (
        carried.withColumn(name, text)
        .withColumn(flag, F.col(date).isNull() & F.col("_previous").isNull())
        .drop("_previous")
    )
