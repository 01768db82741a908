"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: of what the driver holds of one table that it broadcasts; independent jobs do so at the same time
MAX_BROADCAST_BYTES = 16 << 20
#: held for a row beside its values: its own header and its share of the hash table
ROW_BYTES = 64


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df``, as the driver would hold it, is within the broadcast bound; measured, not guessed."""
    width = F.lit(ROW_BYTES)
    for field in df.schema.fields:
        size = F.lit(8)
        if field.dataType.simpleString() in ("string", "binary"):
            size = F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16)
        elif field.dataType.simpleString().startswith(("array", "map", "struct")):
            size = F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        width = width + size
    total = df.agg(F.sum(width.cast("long")).alias("n")).first()["n"]
    return (total or 0) <= MAX_BROADCAST_BYTES


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join ``left`` to ``right`` by "inner", "left", "left_semi", "left_anti"; duplicates on the right multiply.

    ``right`` is broadcast only when its measured size is within the bound. Beyond it this is a shuffled join, which
    adaptive execution splits where a key is hot; the rows are the same either way. Pass a staged ``right``: it is read
    once more for the measurement.
    """
    return equi_join(left, F.broadcast(right) if fits_broadcast(right) else right.hint("merge"), on, how, null_safe)


def bounded_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """``equi_join`` in which Spark chooses what it broadcasts, but nothing beyond the bound.

    Spark goes by the size of files, which may be packed to a fiftieth of what the driver would hold of them. So the side
    that it would broadcast is measured first, unless its files are small however they are packed. The driver would hold
    a table once for each job that broadcasts it.
    """
    sides = {"right": right, "left": left} if how == "inner" else {"right": right}
    guesses = {name: _guessed_bytes(df) for name, df in sides.items()}
    least = min(guesses, key=guesses.get)
    most = right.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if MAX_BROADCAST_BYTES >> 8 < guesses[least] <= most and not fits_broadcast(sides[least]):
        sides[least] = sides[least].hint("merge")
    return equi_join(sides.get("left", left), sides["right"], on, how, null_safe)


def _guessed_bytes(df: DataFrame) -> int:
    """What Spark takes for the size of ``df`` when it plans a join."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    # as text, since a product of sizes may be beyond a long
    return int(stats.productIterator().mkString(",").split(",")[0])


def equi_join(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool) -> DataFrame:
    """Join by columns of the same name, which are kept once; with ``null_safe`` null equals null."""
    if not null_safe:
        return left.join(right, on, how).select(*_output(left, right, on, how))
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, same, how).select(*_output(left, right, on, how))


def _output(left: DataFrame, right: DataFrame, on: list[str], how: str) -> list[str]:
    extra = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in on]
    return [*left.columns, *extra]


def keep_members(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key survives in ``parent``; both keys compare as long, "7.0" as 7, other texts as no key."""
    keys = parent.select(_whole(parent, key).alias(key)).where(F.col(key).isNotNull())
    return lookup(df.withColumn(key, _whole(df, key)), keys, [key], "left_semi")


def _whole(df: DataFrame, key: str) -> Column:
    """A key as long; a text may hold a whole number with zeros behind the point."""
    if df.schema[key].dataType.simpleString() != "string":
        return F.col(key).try_cast("long")
    return F.regexp_replace(F.trim(key), r"\.0*$", "").try_cast("long")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null reference has no parent.

    Both are stored tables, whose sizes Spark knows from their files, so nothing is measured first.
    """
    keys = parent.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull())
    return equi_join(child.where(F.col(fk).isNotNull()), keys, [fk], "left_anti", False)


def attach_ids(df: DataFrame, dim: DataFrame, value: str) -> DataFrame:
    """Add the dimension's id to every row; null finds the id the dimension gave to null."""
    return lookup(df, dim, [value], "left", null_safe=True)


def outer_link(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join in which a null key never matches; both unmatched sides are kept.

    Written as left join + left anti join, both of which Spark can split at run time when one
    key is hot (a full outer join cannot be split). Null keys skip the shuffle altogether.
    """
    known_left, known_right = left.where(F.col(key).isNotNull()), right.where(F.col(key).isNotNull())
    matched = known_left.join(known_right, key, "left")
    right_only = known_right.join(known_left.select(key), key, "left_anti")
    return (
        matched.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)
        .unionByName(right_only, allowMissingColumns=True)
        .unionByName(right.where(F.col(key).isNull()), allowMissingColumns=True)
    )


def name_join(left: DataFrame, right: DataFrame, left_name: Column, right_name: Column) -> DataFrame:
    """Inner join on names in upper case; column names must not overlap, duplicates multiply."""
    a = left.withColumn("_joined", F.upper(left_name)).where(F.col("_joined").isNotNull())
    b = right.withColumn("_joined", right_name).where(F.col("_joined").isNotNull())
    return a.join(b, "_joined", "inner").drop("_joined")


def decode(df: DataFrame, dim: DataFrame, code: str) -> DataFrame:
    """Add the columns of ``dim`` by ``code``; ``dim`` is unique on it."""
    return lookup(df, dim, [code], "left")


def surrogate_join(facts: DataFrame, parents: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Replace a natural key by the parents' surrogate key; facts without parent are left out."""
    return lookup(facts, parents.select(natural, surrogate), [natural], "inner").drop(natural)
