"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are its context and only its reply is trainable.
An example is written out in parts of bounded size, one row each, so neither a row nor a task holds a long conversation's
examples whole. A conversation of n turns takes rows for n examples with their contexts, which is quadratic by nature.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.session import stage

#: marks of the template
START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: turns that begin within so many characters are one part of a context; so many parts go together to one task
PART, BLOCK = 1 << 14, 16


def escape(text: Column) -> Column:
    """Adds a backslash before each ``|`` that follows ``<``, or ``<`` and backslashes, so a text holds no mark."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, piece, head (characters of the piece before the text) and loss (is the text a target?)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), F.url_encode(role), F.lit("\n"))
    piece = F.concat(head, escape(text), F.lit(END + "\n"))
    loss = (role == ASSISTANT).alias("loss")
    return turns.select("conv_id", "turn", role.alias("role"), piece.alias("piece"), F.char_length(head).alias("head"), loss)


def _parts(turns: DataFrame) -> DataFrame:
    """The formatted conversations cut between turns: conv_id, part, part_start, text, ``marks`` and ``last_part``.

    ``marks`` has an entry per example that ends in the part, and one for the turns behind the last example.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "piece")
    whole = Window.partitionBy("conv_id")
    chars = F.char_length("piece").cast("long")
    upto = F.sum(chars).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = formatted(turns).withColumn("place", F.row_number().over(order).cast("long") - 1)
    placed = placed.withColumn("chars", chars).withColumn("start", upto - chars)
    placed = placed.withColumn("last", F.max(F.when(F.col("loss"), F.struct("place", "start"))).over(whole))
    entry = F.struct("place", "start", "chars", "turn", "head", "loss", "piece")
    parts = placed.groupBy("conv_id", F.expr(f"start div {PART}").alias("part")).agg(
        F.array_sort(F.collect_list(entry)).alias("turns"), F.min("start").alias("part_start"), F.max("last").alias("last")
    )

    def example(t: Column) -> Column:
        end, loss_start = t["start"] + t["chars"] - 1, t["start"] + t["head"]
        return F.struct(
            t["place"].alias("place"),
            t["turn"].alias("turn"),
            F.lit(0).cast("long").alias("from"),
            end.alias("prefix_chars"),
            loss_start.alias("loss_start"),
            (end - len(END) - loss_start).alias("loss_chars"),
            (t["place"] == F.col("last.place")).alias("final"),
        )

    def behind(t: Column) -> Column:
        none = F.lit(None).cast("long")
        names = ("prefix_chars", "loss_start", "loss_chars")
        return F.struct(
            none.alias("place"),
            F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
            (t["start"] - F.col("part_start")).alias("from"),
            *(none.alias(n) for n in names),
            F.lit(True).alias("final"),
        )

    rest = F.filter("turns", lambda t: F.col("last").isNull() | (t["place"] > F.col("last.place")))
    marks = F.concat(F.transform(F.filter("turns", lambda t: t["loss"]), example), F.transform(F.slice(rest, 1, 1), behind))
    return parts.select(
        "conv_id",
        "part",
        "part_start",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"),
        marks.alias("marks"),
        F.expr(f"last.start div {PART}").alias("last_part"),
    )


def expand(turns: DataFrame) -> DataFrame:
    """Examples, written out in full: one for each assistant turn, its context and its reply, in rows by ``part``.

    Columns: conv_id, place and turn (of the reply; places count 0, 1, ... in the conversation), part, part_start (where
    the part begins in the example), text, prefix_chars (length of the whole example), loss_start and loss_chars (span of
    the reply in it) and final (is it the conversation's last example?). The parts of an example in order are its text.
    Turns behind the last example are in no example; they are rows without place, so that nothing is lost.

    Turns are taken by ``turn``, nulls first, then by role and text, so ties have a fixed order; equal rows all stay. A
    null text or role is empty, a null conversation is one of its own, an empty table gives no rows, further columns are
    not looked at. Offsets depend on all turns before, so one task sorts a conversation, spilling. A context of many parts
    is joined to the examples block by block: a task holds a block of parts, however long the conversation is.
    """
    parts = stage(_parts(turns), "chat-parts")
    example = [F.col(f"mark.{n}").alias(n) for n in ("place", "turn", "prefix_chars", "loss_start", "loss_chars", "final")]
    upto = F.coalesce(F.col("mark.prefix_chars") - F.col("part_start"), F.char_length("text"))
    names = ["conv_id", "place", "turn", "part", "part_start", "text", "prefix_chars", "loss_start", "loss_chars", "final"]
    ends = parts.select("conv_id", "part", "part_start", "text", F.explode("marks").alias("mark")).select(
        "conv_id",
        "part",
        "part_start",
        F.substring("text", (F.col("mark.from") + 1).cast("int"), (upto - F.col("mark.from")).cast("int")).alias("text"),
        *example,
    )

    block = F.expr(f"part div {BLOCK}")
    later = F.sequence(block, F.expr(f"last_part div {BLOCK}"))
    contexts = parts.where("part < last_part").select(
        F.col("conv_id").alias("c"), "part", "part_start", "text", block.alias("p"), F.explode(later).alias("q")
    )
    earlier = F.sequence(F.lit(0).cast("long"), block)
    targets = parts.where("part > 0").select("conv_id", F.col("part").alias("end"), F.explode("marks").alias("mark"), earlier.alias("ps"))
    targets = targets.where("mark.place IS NOT NULL").select(
        "conv_id", "end", *example, F.expr(f"end div {BLOCK}").alias("block"), F.explode("ps").alias("from_block")
    )
    pairs = (
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("from_block") == F.col("p")) & (F.col("block") == F.col("q"))
    )
    before = targets.join(contexts, pairs & (F.col("part") < F.col("end")))
    return ends.select(*names).unionByName(before.select(*names))


def example_texts(expanded: DataFrame) -> DataFrame:
    """conv_id, place, text, loss_start, loss_chars: every example in one row, for conversations of ordinary length."""
    parts = F.array_sort(F.collect_list(F.struct("part", "text")))
    return expanded.where("place IS NOT NULL").groupBy("conv_id", "place").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"),
        F.first("loss_start").alias("loss_start"),
        F.first("loss_chars").alias("loss_chars"),
    )


def _said(text: Column) -> Column:
    """Role and text of each turn in a formatted text, a line break behind both."""

    def turn(piece: Column) -> Column:
        at = F.instr(piece, "\n")
        tail = F.when(piece.endswith("\n"), len(END) + 1).otherwise(len(END))
        body = F.substring(piece, at + 1, F.char_length(piece) - at - tail)
        return F.concat(F.url_decode(F.substring(piece, F.lit(1), at - 1)), F.lit("\n"), unescape(body), F.lit("\n"))

    pieces = F.split(text, START.replace("|", r"\|"))
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def digests(expanded: DataFrame) -> DataFrame:
    """Per conversation, read back from the examples: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (sum
    of the lengths of its examples) and n_examples.

    Replies are cut out of every example under its loss span, all turns out of the last example and what is behind it, by
    the template's marks. A digest over all turns in order is sequential by nature: what was read of a conversation
    streams, sorted, through one hash object, so memory stays one batch. Contexts do not move; only their lengths do.
    """
    chars = F.char_length("text").cast("long")
    is_end = F.col("part_start") + chars == F.col("prefix_chars")
    reply = F.substring("text", (F.col("loss_start") - F.col("part_start") + 1).cast("int"), F.col("loss_chars").cast("int"))
    said = F.when(F.col("final"), _said(F.col("text")))
    read = expanded.select(
        "conv_id",
        "place",
        "part",
        F.when(F.col("place").isNotNull(), chars).alias("chars"),
        F.when(is_end, unescape(reply)).alias("target"),
        F.array_join(said, "").alias("said"),
        F.size(said).alias("turns"),
    )
    read = read.repartition("conv_id").sortWithinPartitions("conv_id", F.col("place").asc_nulls_last(), "part")
    longs, texts = ("n_turns", "loss_chars", "formatted_chars", "n_examples"), ("turns_sha256", "loss_sha256")
    schema = T.StructType(
        [T.StructField("conv_id", read.schema["conv_id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in longs]
        + [T.StructField(n, T.StringType()) for n in texts]
    )
    return read.mapInArrow(_digest(schema.names), schema)


def _digest(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, done = None, None, []

        def row() -> tuple:
            return (conv, *state[:4], state[4].hexdigest(), state[5].hexdigest())

        def batch_of(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, *[pa.int64()] * 4, *[pa.string()] * 2]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        kind = None
        for batch in batches:
            kind = batch.column("conv_id").type
            columns = (batch.column(n).to_pylist() for n in ("conv_id", "chars", "target", "said", "turns"))
            for c, chars, target, said, turns in zip(*columns):
                if state is None or c != conv:
                    if state is not None:
                        done.append(row())
                    conv, state = c, [0, 0, 0, 0, hashlib.sha256(), hashlib.sha256()]
                if said is not None:
                    state[0] += turns
                    state[4].update(said.encode())
                if chars is not None:
                    state[2] += chars
                if target is not None:
                    state[1] += len(target)
                    state[3] += 1
                    state[5].update(target.encode())
            if len(done) > 5000:
                yield batch_of(done, kind)
                done = []
        if state is not None:
            yield batch_of([*done, row()], kind)

    return run
