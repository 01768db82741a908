"""Consecutive ids without pulling the rows through one task.

Every id follows an explicit order key that is unique per row; the order is never taken from
the physical layout.
"""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.session import stage_packed

SYNTHETIC_BASE = 1_000_000_000  # fixed value: first key given to records without one
_SLOT = "_slot"


def number_rows(df: DataFrame, order: list, name: str, start: int = 0) -> DataFrame:
    """Add ``name`` = start, start+1, ... in the order of ``order`` (unique over the rows).

    A range sort spreads the rows evenly; each row keeps its place inside its sort partition
    (`monotonically_increasing_id` right after the sort, fixed by writing the table), and the
    partitions' start values are added afterwards. Only one row per sort partition, so at most
    ``spark.sql.shuffle.partitions`` rows, reaches the driver.
    """
    spark = df.sparkSession
    placed = stage_packed(df.orderBy(*order).withColumn(_SLOT, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(_SLOT), 33)
    sizes = sorted(placed.groupBy(part.alias("p")).count().collect())
    bases = list(accumulate((rows for _, rows in sizes), initial=start))[: len(sizes)]
    offsets = spark.createDataFrame(
        pa.table({"_part": pa.array([p for p, _ in sizes], pa.int64()), "_base": pa.array(bases, pa.int64())})
    )
    place = F.col(_SLOT).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_base") + place).alias(name))
    )


def first_positions(df: DataFrame, values: list[str], order: list[str], unique: bool = False) -> DataFrame:
    """Each distinct value with the smallest position it occurs at.

    Map-side combined, so a value that fills a third of the rows leaves one row per task. With
    a composite position the last part is reduced first by hash aggregation, unless ``unique``
    says that no value occurs twice under the leading parts; only the remaining rows are
    compared by the whole position. Positions are not null.
    """
    *outer, inner = order
    if not outer:
        return df.groupBy(*values).agg(F.min(inner).alias(inner))
    if not unique:
        df = df.groupBy(*values, *outer).agg(F.min(inner).alias(inner))
    if len(outer) == 1:
        # hash aggregation when both parts are numbers
        return df.groupBy(*values).agg(F.min(outer[0]).alias(outer[0]), F.min_by(inner, outer[0]).alias(inner))
    first = df.groupBy(*values).agg(F.min(F.struct(*order)).alias("_first"))
    return first.select(*values, *[F.col(f"_first.{c}").alias(c) for c in order])


def dense_ids(
    df: DataFrame,
    value: str,
    order: list[str],
    name: str,
    start: int = 1,
    nulls: str = "own",
    unique: bool = False,
) -> DataFrame:
    """Dimension (value, id), numbered by first appearance.

    ``nulls``: "own" gives null an id like any value, "drop" leaves it out, "zero" gives it the
    id before the first one (0 when numbering from 1, -1 when numbering from 0).
    """
    is_null = F.col(value).isNull()
    firsts = first_positions(df.where(~is_null) if nulls == "drop" else df, [value], order, unique)
    if nulls != "zero":
        return number_rows(firsts, order, name, start).select(value, name)
    # null sorts last and takes no number from the others
    dim = number_rows(firsts, [is_null, *order], name, start)
    return dim.select(value, F.when(is_null, F.lit(start - 1)).otherwise(F.col(name)).cast("long").alias(name))


def row_ids(df: DataFrame, columns: list[str], order: list[str], name: str, start: int = 0) -> DataFrame:
    """Distinct rows over ``columns``, numbered by first appearance."""
    firsts = first_positions(df, columns, order)
    return number_rows(firsts, order, name, start).select(*columns, name)


def synthetic_keys(
    df: DataFrame, key: str, order: list[str], base: int = SYNTHETIC_BASE, skip: int = 0
) -> DataFrame:
    """Give rows without a key base, base+1, ...; the first ``skip`` of them are left out."""
    keyed = df.where(F.col(key).isNotNull())
    missing = number_rows(df.where(F.col(key).isNull()).drop(key), order, key, base)
    if skip:
        missing = missing.where(F.col(key) >= base + skip)
    return keyed.withColumn(key, F.col(key).cast("long")).unionByName(missing)


def sort_nulls_last(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) for c in columns])


def skip_rows(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """All rows but the first ``n`` by ``columns``, nulls last; which of equal rows are skipped is left open.

    ``offset`` would move every row through one task, so the rows are numbered.
    """
    if n <= 0:
        return df
    order = [F.asc_nulls_last(c) for c in columns]
    return number_rows(df, order, "_row").where(F.col("_row") >= n).drop("_row")


def carry_forward(
    df: DataFrame, parts: list[str], order: str, value: str, name: str, width: int = 1_000_000
) -> DataFrame:
    """Add ``name`` = last non-null ``value`` strictly before the row within ``parts``.

    ``parts`` are not null; ``order`` is an integer, unique within them. Rows are cut into blocks of ``width``
    positions, so one task sorts at most ``width`` rows of a group however large the group is;
    the value carried into each block comes from a table with one row per block, of which one
    task sees at most the range of ``order`` divided by ``width`` (row numbers are dense).
    """
    block = F.floor(F.col(order) / F.lit(width)).alias("_block")
    blocks = (
        df.groupBy(*parts, block)
        .agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_tail"))
        .select(
            *parts,
            "_block",
            F.last("_tail", ignorenulls=True)
            .over(_rows_before(Window.partitionBy(*parts).orderBy("_block")))
            .alias("_carried"),
        )
    )
    inside = F.last(value, ignorenulls=True).over(
        _rows_before(Window.partitionBy(*parts, "_block").orderBy(order))
    )
    near = df.withColumn("_block", block).withColumn("_near", inside)
    # plain equality: the join then reuses the partitioning and order of the window
    return near.join(blocks, [*parts, "_block"], "left").select(
        *df.columns, F.coalesce("_near", "_carried").alias(name)
    )


def _rows_before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)
