"""Forward as-of linking: for each left row the nearest right row on or after its date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


_NULL_RULES = ("right_wild", "left_wild", "exclude")


def link_forward(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    date: str,
    left_pos: str,
    right_pos: str,
    value: str,
    null_rule: str = "right_wild",
) -> DataFrame:
    """Pairs (right_pos, value): each chosen right row with the value of its last chooser.

    A left row chooses, among right rows equal in ``keys``, the earliest ``date`` on or after its
    own; equal dates go to the smaller ``right_pos``. If several left rows choose one right row,
    the largest ``left_pos`` wins. Null dates: "right_wild" - a left row without date chooses
    nothing, a right row without date is the fallback; "left_wild" - a left row without date
    chooses the earliest right row, an undated one last; "exclude" - null matches nothing.

    Left rows equal in keys and date make the same choice, and right rows equal in keys and date
    compete only by position. Both sides are therefore first reduced together to one row per
    keys and date (map-side combined), which bounds the rows per key by the number of calendar
    days however many people share a name. One window over that finds all choices; no pairs are
    emitted.
    """
    if null_rule not in _NULL_RULES:
        raise ValueError(f"null_rule must be one of {_NULL_RULES}")
    for side in (left, right):
        if side.schema[date].dataType.simpleString() != "date":
            raise TypeError(f"{date} must be a date column")
    last = F.when(F.col(left_pos).isNotNull(), F.struct(F.col(left_pos).alias("_lpos"), F.col(value).alias("_value")))
    choosers = left.select(*keys, date, last.alias("_last"))
    if null_rule != "left_wild":
        choosers = choosers.where(F.col(date).isNotNull())
    candidates = right.select(*keys, date, F.col(right_pos).alias("_rpos"))
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    days = (
        choosers.unionByName(candidates, allowMissingColumns=True)
        .where(known)
        .groupBy(*keys, date)
        .agg(F.max("_last").alias("_last"), F.min("_rpos").alias("_rpos"))
    )

    # from the latest day back, so the last candidate seen is the nearest one; a day without
    # date stands first when it is everyone's fallback, last when it may take any day
    dated = F.when(F.col(date).isNotNull(), F.col("_rpos"))
    undated = F.when(F.col(date).isNull(), F.col("_rpos"))
    latest = F.col(date).desc_nulls_first() if null_rule == "right_wild" else F.col(date).desc_nulls_last()
    seen = Window.partitionBy(*keys).orderBy(latest).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    choice = F.last(dated, ignorenulls=True).over(seen)
    if null_rule == "right_wild":
        choice = F.coalesce(choice, F.last(undated, ignorenulls=True).over(seen))
    elif null_rule == "left_wild":
        choice = F.coalesce(choice, undated)
    return (
        days.withColumn("_choice", choice)
        .where(F.col("_last").isNotNull() & F.col("_choice").isNotNull())
        .groupBy(F.col("_choice").alias(right_pos))
        .agg(F.max("_last")["_value"].alias(value))
    )


def apply_links(right: DataFrame, links: DataFrame, right_pos: str, value: str, target: str) -> DataFrame:
    """Write the linked values over ``target``; rows nobody chose keep theirs.

    There may be a link for every row, and they are dealt by ``right_pos`` already, so they are never broadcast.
    """
    links = links.withColumnRenamed(value, "_linked").hint("merge")
    linked = right.join(links, right_pos, "left")
    old = F.col(target) if target in right.columns else F.lit(None)
    return linked.withColumn(target, F.coalesce("_linked", old)).drop("_linked")


