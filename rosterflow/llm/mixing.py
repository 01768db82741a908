"""Mixing sources to target weights by thresholds on a hash of the id.

Words are summed by source and hash bucket; the bucket in which a source's budget ends is split further by the next
bits of the hash, and only that one, until the threshold is a single hash value. Rows of that hash (one, unless an id
repeats or is missing) are split in the same way by size and by their place in the files. Documents are then filtered
without sorting. A budget beyond one pass over a source is nested: every row is taken once and those under the
threshold once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.common import word_count
from rosterflow.llm.located import located
from rosterflow.llm.sampling import id_hash
from rosterflow.session import stage

#: bits of the hash that each round of histograms looks at; a source's histogram has at most 2 ** BITS rows
BITS, ROUNDS = 15, 4
#: rounds for the size of a text (a string is below 2 ** 31 bytes, so it has less than 2 ** 30 words) and for ties
SIZE_ROUNDS, TIE_ROUNDS = 2, 3
MAX_REPEATS = 2


def targets(sizes: DataFrame, weights: list[float], total: float, repeats: int = MAX_REPEATS) -> DataFrame:
    """``sizes`` (source, source_size: a row per source) with each source's target, at most ``repeats`` times its size.

    Sources in code point order, null last, take ``weights`` in turn and share ``total`` times all words. What a capped
    source leaves is shared by weight among the others until none is above. In the order of size over weight the capped
    sources come first, so two running sums find the common level. One row per source meets in one task here: the
    sources of a mix are a short list, whatever the number of documents.
    """
    place = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    turn = (F.row_number().over(place) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    most = F.col("source_size") * F.lit(float(repeats))
    weighed = weighed.withColumn("most", most).withColumn("level", most / F.col("weight"))
    order = Window.orderBy("level", F.col("source").isNull(), F.encode("source", "UTF-8"))
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * F.lit(float(total))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))
    left = budget - F.coalesce(F.sum("most").over(below), F.lit(0.0))
    share = weighed.withColumn("share", left / open_weight)
    # the level is the share of the first source that it does not cap; none: every source is capped
    level = F.max(F.when(F.col("share") <= F.col("level"), F.col("share"))).over(everything)
    target = F.least("most", F.coalesce(F.col("weight") * level, F.col("most")))
    return share.withColumn("target", target).select("source", "source_size", "target")


def _piece(key: str, level: int, rounds: int) -> Column:
    """The bits of the key that round ``level`` looks at."""
    return F.shiftright(key, BITS * (rounds - level - 1)).bitwiseAND(F.lit((1 << BITS) - 1))


def _prefix(key: str, level: int, rounds: int) -> Column:
    """The bits before them; 0 in the first round."""
    return F.shiftright(key, BITS * (rounds - level))


def _edges(rows: DataFrame, bounds: DataFrame, key: str, rounds: int) -> DataFrame:
    """``bounds`` (name, rest) with ``edge``, the value of ``key`` with which a source's sum by ``key`` reaches its
    rest, ``rest`` as what is left before that value, and ``words``, the sum of its rows.

    ``rows``: source, size and ``key``, a number of ``rounds`` times BITS bits. Each round sums one piece of the bits
    and goes on within the piece in which the rest is reached; the last piece if it is never reached.
    """
    bounds = bounds.select("name", "rest", F.lit(0).cast("long").alias("prefix"))
    for level in range(rounds):
        within = _prefix(key, level, rounds) == bounds["prefix"]
        inside = rows.join(bounds, rows["source"].eqNullSafe(bounds["name"]) & within)
        sums = inside.groupBy("name", "rest", "prefix", _piece(key, level, rounds).alias("piece")).agg(
            F.sum("size").alias("words")
        )
        upto = Window.partitionBy("name").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("words").over(upto))
        before = F.col("upto") - F.col("words")
        reached = F.min(F.when(F.col("upto") >= F.col("rest"), F.col("piece")))
        ends = sums.groupBy(F.col("name").alias("owner")).agg(F.coalesce(reached, F.max("piece")).alias("end"))
        at = sums.join(ends, sums["name"].eqNullSafe(ends["owner"]) & (sums["piece"] == ends["end"]))
        bounds = stage(at.select(
            "name",
            (F.col("rest") - before).alias("rest"),
            F.shiftleft("prefix", BITS).bitwiseOR(F.col("piece")).alias("prefix"),
            "words",
        ), f"mix-{key}-{level}")
    return bounds.withColumnRenamed("prefix", "edge")


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``budgets`` (source, target, source_size) with ``repeats`` (whole passes) and the place at which one more ends.

    ``rows``: source, hash, size, tie. Rows are in the order of hash, size and tie. A row is taken once more if it is
    before ``last``, ``last_size`` and ``last_tie``, and also at them if ``closed``, that is, if the sum comes nearer to
    the target with it. Rows of one hash, as those of an id that repeats or of no id, are therefore parted as well.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    passes = budgets.withColumn("repeats", whole.cast("long"))
    rest = F.col("target") - F.col("repeats") * F.col("source_size")
    found = stage(passes.select(F.col("source").alias("name"), "repeats", rest.alias("rest")), "mix-bounds")
    for key, rounds, last in (("hash", ROUNDS, "last"), ("size", SIZE_ROUNDS, "last_size"), ("tie", TIE_ROUNDS, "last_tie")):
        if key != "hash" and rows.groupBy("source").count().where("count > 1").isEmpty():
            edges = rows.join(found, rows["source"].eqNullSafe(found["name"]))  # one row a source: nothing to part
            edges = edges.select("name", "rest", F.col(key).alias("edge"), F.col("size").alias("words"))
        else:
            edges = _edges(rows, found.select("name", "rest"), key, rounds)
        edges = edges.withColumnsRenamed({"edge": last, "name": "owner"})
        same = found["name"].eqNullSafe(edges["owner"])
        found = stage(found.drop("rest", "words").join(edges, same).drop("owner"), f"mix-to-{last}")
        if key != "tie":
            ends = found.select("name", F.col(last).alias("end"))
            at = rows["source"].eqNullSafe(ends["name"]) & (rows[key] == ends["end"])
            rows = stage(rows.join(ends, at).drop("name", "end"), f"mix-at-{last}")
    return found.select(
        "name", "repeats", "last", "last_size", "last_tie", (F.col("rest") * 2 >= F.col("words")).alias("closed")
    )


def _tie() -> Column:
    """The first bits of the MD5 of a row's place in its file: parts rows of one hash and size."""
    place = F.concat_ws(":", F.col("_metadata.row_index").cast("string"), F.col("_metadata.file_path"))
    digits = F.substring(F.md5(place), 1, 12)
    return F.shiftright(F.conv(digits, 16, 10).cast("long"), 48 - TIE_ROUNDS * BITS)


def _narrow(docs: DataFrame) -> DataFrame:
    size = word_count(F.col("text"))
    return docs.select(
        "doc_id", "source", size.alias("size"), id_hash(F.col("doc_id")).alias("hash"), _tie().alias("tie")
    )


def _bounds(rows: DataFrame, weights: list[float], total: float, repeats: int) -> DataFrame:
    """One row per source: name, repeats, last, last_size, last_tie, closed, source_size and target."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    budgets = stage(targets(sizes, list(weights), total, repeats), "mix-targets")
    budgets_by_name = budgets.withColumnRenamed("source", "origin")
    bounds = thresholds(rows.drop("doc_id"), budgets).join(budgets_by_name, F.col("name").eqNullSafe(F.col("origin")))
    return stage(bounds.drop("origin"), "mix-sources")


def _times(repeats: int, size: Column) -> Column:
    """How often a row is taken, from its hash, size and tie and its source's bounds."""
    hash_, tie = F.col("hash"), F.col("tie")
    once_more = (
        F.when(hash_ != F.col("last"), hash_ < F.col("last"))
        .when(size != F.col("last_size"), size < F.col("last_size"))
        .when(tie != F.col("last_tie"), tie < F.col("last_tie"))
        .otherwise(F.col("closed"))
    )
    return F.col("repeats") + F.when(once_more & (F.col("repeats") < repeats), 1).otherwise(0)


def mix(
    docs: DataFrame, weights: list[float] = (5, 2, 1), total: float = 1.5, repeats: int = MAX_REPEATS
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words that the mix takes, repeats counted) of every row.

    Size is the number of words, 0 for a null text. The choice hangs on the hash of the id; among rows of one id, and
    those without id, shorter ones are taken first, and of equally long ones those with the least hash of their place in
    the files. Reruns over the same files agree. A source of empty texts has target and taken 0. A null source is a
    source. An empty table gives no rows. Further columns are not looked at.
    """
    rows = stage(_narrow(located(docs)), "mix-rows")
    joined = rows.join(_bounds(rows, weights, total, repeats), F.col("source").eqNullSafe(F.col("name")))
    taken = (F.col("size") * _times(repeats, F.col("size"))).alias("taken")
    return joined.select("doc_id", "source", "size", "source_size", "target", taken)


def mixed_rows(
    docs: DataFrame, weights: list[float] = (5, 2, 1), total: float = 1.5, repeats: int = MAX_REPEATS
) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix takes them. Texts are not shuffled as long as
    the table of sources is small enough for Spark to broadcast it."""
    docs = located(docs)
    bounds = _bounds(stage(_narrow(docs), "mix-rows"), weights, total, repeats)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), _tie().alias("tie"))
    rows = rows.select("doc", "tie", id_hash(F.col("doc.doc_id")).alias("hash"))
    joined = rows.join(bounds, F.col("doc.source").eqNullSafe(F.col("name")))
    times = _times(repeats, word_count(F.col("doc.text")))
    copies = joined.select("doc", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return copies.select("doc.*")
