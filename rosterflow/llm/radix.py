"""Ranks by a distributed radix sort, least significant digit first.

Rows have places 0, 1, 2, ... and are read in blocks of consecutive places. A pass counts each block's rows by digit; sums
of the counts over smaller digits, and over earlier blocks of the same digit, say where each block's rows of a digit
start, and a row goes there by its rank among them. Every pass keeps the order of equal digits, so after the last one
the place of a row is its rank. No task holds more than a block of one digit, no window runs over all rows, and each
pass is written, so a lost executor repeats part of one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.session import stage

#: places of a block and bits of a digit: a block has at most 2 ** DIGIT_BITS counts
BLOCK_BITS, DIGIT_BITS = 17, 12


def placed(rows: DataFrame, name: str) -> DataFrame:
    """Add a place 0, 1, 2, ... to rows read from files: the file's offset, which follows from the counts, and the row
    in it. One row per file meets in one task."""
    known = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = known.groupBy("_file").count()
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    return known.join(starts, "_file").select(*rows.columns, (F.col("_start") + F.col("_row")).alias(name))


def ordered(value: Column, descending: bool = False) -> Column:
    """A long whose bits, read as unsigned, stand in the order of ``value``."""
    turned = value.cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    return F.bitwise_not(turned) if descending else turned


def digits_of(rows: DataFrame, fields: list[str], bits: int) -> list[Column]:
    """Digits of the composite key, least significant first; ``fields`` (unsigned longs) from most to least significant.

    Leading bits that all rows share are left out. A digit may take its bits from several fields.
    """
    ends = rows.agg(*[F.bit_or(f).alias(f"o{i}") for i, f in enumerate(fields)], *[F.bit_and(f).alias(f"a{i}") for i, f in enumerate(fields)]).first()
    pieces = []
    for i in reversed(range(len(fields))):
        varying = ((ends[f"o{i}"] or 0) ^ (ends[f"a{i}"] or 0)) & ((1 << 64) - 1)
        pieces.append((fields[i], varying.bit_length()))
    digits, digit, filled = [], None, 0
    for field, width in pieces:
        at = 0
        while at < width:
            take = min(bits - filled, width - at)
            part = F.shiftleft(F.shiftrightunsigned(field, at).bitwiseAND(F.lit((1 << take) - 1)), filled)
            digit = part if digit is None else digit.bitwiseOR(part)
            at, filled = at + take, filled + take
            if filled == bits:
                digits.append(digit)
                digit, filled = None, 0
    return digits if digit is None else [*digits, digit]


def counting_pass(rows: DataFrame, place: str, digit: Column, block_bits: int) -> DataFrame:
    """Rows with their places after a stable counting sort by ``digit``."""
    by = ["_block", "_digit"]
    dealt = rows.withColumn("_block", F.shiftright(place, block_bits)).withColumn("_digit", digit)
    counts = dealt.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    # one row per digit value meets in one task
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_n"))
    bases = totals.select("_digit", F.coalesce(F.sum("_n").over(smaller), F.lit(0)).alias("_base"))
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(bases, "_digit")
    offsets = offsets.select(*by, (F.col("_base") + F.col("_before")).alias("_start"))
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(place)) - 1
    ranked = dealt.withColumn("_nth", nth).join(offsets, by)
    return ranked.select(*[c for c in rows.columns if c != place], (F.col("_start") + F.col("_nth")).alias(place))


def radix_places(
    rows: DataFrame, keys: list[Column], place: str, bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Staged ``rows`` with ``place``: 0, 1, 2, ... in the order of ``keys`` (see ``ordered``), most significant first.

    Equal keys keep the order in which the rows were written. An empty table gives no rows.
    """
    fields = [f"_field{i}" for i in range(len(keys))]
    keyed = stage(placed(rows, place).select("*", *[k.alias(f) for k, f in zip(keys, fields)]), "radix-0")
    for number, digit in enumerate(digits_of(keyed, fields, bits), 1):
        keyed = stage(counting_pass(keyed, place, digit, block_bits), f"radix-{number}")
    return keyed.drop(*fields)
