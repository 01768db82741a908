"""SimHash near-duplicates: pigeonhole blocks find close fingerprints, then the Hamming distance is verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.llm.common import texts_of, typed
from rosterflow.llm.components import smallest_reachable
from rosterflow.llm.located import located, locator, without
from rosterflow.session import stage

SEED = 42
#: rows whose bits are added in bytes before they are widened
_LANE = 255


def fingerprint(text: str, shingle: int = 3) -> int:
    """64 bits, each 1 if set in over half the hashes of the text's word shingles; 0 without words."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[: -shingle]))
        digest = xxhash.xxh64_intdigest
        spans = zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _LANE * 64):
        bits = np.unpackbits(hashes[at : at + _LANE * 64].view(np.uint8)).reshape(-1, 64)
        whole = len(bits) // _LANE * _LANE
        if whole:
            lanes = np.add.reduce(bits[:whole].reshape(-1, _LANE, 64), axis=1, dtype=np.uint8)
            counts += lanes.sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Every column of ``docs`` but its text, and the fingerprint (long); a null text is empty."""
    others = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*typed(docs, *others), T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches):
            prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            columns = [*(batch.column(c) for c in others), pa.array(prints)]
            yield pa.record_batch(columns, names=[*others, "fingerprint"])

    return docs.mapInArrow(run, schema)


def _masks(bits: int, blocks: int) -> list[int]:
    """Signed masks of every choice of blocks that a pair within ``bits`` bits is sure to share."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(block, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, bits: int = 3, blocks: int = 6) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints with a < b that differ in at most ``bits`` bits, each pair once.

    Of ``blocks`` blocks a pair within ``bits`` bits shares ``blocks - bits`` whole ones, so every choice of that many
    blocks is a join key: with 6 and 3, 20 keys of 31 to 33 bits. More blocks give longer keys and fewer chance
    meetings. A pair is kept where its first shared choice is the key, so it does not come out of several keys.
    """
    masks = _masks(bits, blocks)

    def keyed(name: str) -> DataFrame:
        choices = [F.struct(F.lit(i).alias("c"), F.col(name).bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)]
        return prints.select(F.col("fingerprint").alias(name)).withColumn("at", F.explode(F.array(*choices)))

    left, right = keyed("a"), keyed("b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first: Column = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    near = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= bits) & (first == left["at"]["c"])
    same = (left["at"]["c"] == right["at"]["c"]) & (left["at"]["k"] == right["at"]["k"])
    return left.join(right, same & near).select("a", "b")


def _grouped(prints: DataFrame, bits: int, blocks: int) -> DataFrame:
    """(fingerprint, root): the least fingerprint that each one reaches over links."""
    distinct = stage(prints.select("fingerprint").distinct(), "simhash-distinct")
    reached = smallest_reachable(links(distinct, bits, blocks))
    return distinct.join(reached, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )


def near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3, blocks: int = 6) -> DataFrame:
    """doc_id, fingerprint (long) and component_id (smallest doc_id reachable over links, itself included) per row.

    Equal fingerprints are one node, so copies are never paired. Texts without words have fingerprint 0 and are linked
    like any other. Equal rows stay separate rows of one component; a null id stays null and does not name a component
    unless all its ids are null. An empty table gives no rows. Further columns are not looked at.
    """
    prints = stage(fingerprints(docs.select("doc_id", "text"), shingle), "simhash")
    roots = stage(_grouped(prints, bits, blocks), "simhash-roots")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    names = roots.join(least, "fingerprint").groupBy("root").agg(F.min("least").alias("component_id"))
    known = roots.join(names, "root").select("fingerprint", "component_id")
    return prints.join(known, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3, blocks: int = 6) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: of each component the row with the smallest id (a null
    id comes last), of rows with equal ids the first in the files."""
    docs = located(docs)
    rows = docs.select("doc_id", "text", locator().alias("at"))
    prints = stage(fingerprints(rows, shingle), "simhash")
    roots = stage(_grouped(prints, bits, blocks), "simhash-roots")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "at")
    best = prints.groupBy("fingerprint").agg(F.min(rank).alias("best"))
    best = roots.join(best, "fingerprint").groupBy("root").agg(F.min("best").alias("best"))
    kept = roots.join(best, "root").select("fingerprint", F.col("best.at").alias("kept"))
    dropped = prints.join(kept, "fingerprint").where("at != kept").select("at")
    return without(docs, dropped)
