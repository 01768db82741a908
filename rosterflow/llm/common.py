"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: a run of characters that are not ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def typed(df: DataFrame, *names: str) -> list[T.StructField]:
    """Fields of some columns as they are, but nullable."""
    return [T.StructField(n, df.schema[n].dataType, True) for n in names]


def texts_of(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each Arrow batch with its texts as Python strings, null as empty."""
    for batch in batches:
        yield batch, [t or "" for t in batch.column(name).to_pylist()]


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True where crc32 of the id's text leaves ``part`` modulo ``parts``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def lists_of(table: pa.Table, name: str) -> list[np.ndarray]:
    """The lists of a column as arrays that share one buffer."""
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:])]
