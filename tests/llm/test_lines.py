"""Reversible line deduplication: filters, brute force, growth by batches, deletions."""

import hashlib
import uuid

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import CLASHES, COLUMNS, empty, messy, random_docs
from pyspark.sql import functions as F

from rosterflow.llm import line_dedup
from rosterflow.llm.cuckoo import CuckooFilter
from rosterflow.session import checkpoint_root, stage

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    line = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    return line if len(line) >= 10 else None


def brute(rows, held=None):
    """(doc_id, n_lines, n_dropped, kept text) of rows (doc_id, text, ...); ``held``: rows of the whole corpus."""
    owner = {}
    for r in rows if held is None else held:
        for line in (r[1] or "").split("\n"):
            rank = (r[0] is None, r[0])
            owner[key(line)] = min(owner.get(key(line), rank), rank)
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if key(x) is None or owner[key(x)] == (r[0] is None, r[0])]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=repr)


def new_index(spark):
    return line_dedup.create(spark, f"{checkpoint_root(spark)}/lines-test-{uuid.uuid4().hex}")


def line_docs(spark, n=120, seed=3):
    """Texts whose lines come from a small set: some long enough, some not, with case and blanks changed."""
    rng = np.random.default_rng(seed)
    pool = [f"common line number {i}" for i in range(30)] + ["short", "", "Übergrößen", "Übergröße", "x" * 10, "x" * 9]
    rows = []
    for i in rng.permutation(n).tolist():
        lines = [pool[j] for j in rng.integers(len(pool), size=rng.integers(0, 9))] + [f"own line of {i}"]
        lines = [(" " * rng.integers(3) + x.upper() + "\r" if rng.random() < 0.3 else x) for x in lines]
        text = None if rng.random() < 0.05 else "\n".join(lines)
        rows.append((i, text, "en", "s", 0))
    return spark.createDataFrame(rows, COLUMNS), rows


def hashes(n, seed):
    return np.random.default_rng(seed).integers(1 << 63, size=n, dtype=np.int64).view(np.uint64) * np.uint64(3)


def test_filter_finds_all_that_was_added():
    made, known, other = CuckooFilter(1 << 10), hashes(3500, 1), hashes(20_000, 2)
    for part in np.array_split(known, 7):
        made.add(part)
    assert made.contains(known).all()
    assert made.contains(other).mean() < 0.001
    made = CuckooFilter.from_bytes(made.to_bytes())
    made.remove(known[::2])
    assert made.contains(known[1::2]).all() and made.contains(known[::2]).mean() < 0.01
    made.remove(known[1::2])
    assert not made.cells.any()


def test_filter_refuses():
    full = CuckooFilter(4)
    with pytest.raises(OverflowError):
        full.add(hashes(17, 3))
    with pytest.raises(KeyError):
        CuckooFilter(4).remove(hashes(1, 4))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 40)), max_size=60))
def test_filter_against_a_multiset(steps):
    # few different hashes that share prints and buckets
    value = [np.uint64((i % 3) << 48 | (i % 5)) for i in range(41)]
    made, held = CuckooFilter(64), []
    for add, i in steps:
        alike = [j for j in held if value[j] == value[i]]
        if add and len(alike) < 2:
            made.add(np.array([value[i]]))
            held.append(i)
        elif not add and i in held:
            made.remove(np.array([value[i]]))
            held.remove(i)
        assert all(made.contains(np.array([value[j] for j in held], np.uint64)))
        assert np.count_nonzero(made.cells) == len(held)


def test_repeated_hashes_in_one_call():
    made, same = CuckooFilter(64), np.full(6, 7 << 48 | 5, np.uint64)
    made.add(same)
    made.remove(same[:5])
    assert made.contains(same).all() and np.count_nonzero(made.cells) == 1


@pytest.mark.parametrize("sent", [line_dedup.MOST_SENT, -1])
def test_against_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(line_dedup, "MOST_SENT", sent)
    for df, rows in (line_docs(spark), random_docs(spark)):
        df = stage(df, "line-docs")
        keys = line_dedup.line_keys(df)
        found = line_dedup.clean(df, line_dedup.insert(new_index(spark), keys), keys)
        assert found.columns == [*df.columns, "n_lines", "n_dropped"]
        assert result(found) == brute(rows) and any(r[2] for r in brute(rows))


def test_batches_and_deletions(spark):
    df, rows = line_docs(spark)
    index = new_index(spark)
    for part in range(3):  # ids come in any order, so later batches take lines away from earlier ones
        index = line_dedup.insert(index, line_dedup.line_keys(df.where(F.col("doc_id") % 3 == part)))
    assert result(line_dedup.clean(df, index)) == brute(rows)
    less = line_dedup.delete(index, spark.createDataFrame([(i,) for i in [*range(0, 40), 999]], "doc_id long"))
    left = [r for r in rows if r[0] >= 40]
    assert result(line_dedup.clean(df.where("doc_id >= 40"), less)) == brute(left)
    # the state before is still there, and inserting again gives it back
    assert result(line_dedup.clean(df, index)) == brute(rows)
    again = line_dedup.insert(less, line_dedup.line_keys(df.where("doc_id < 40")))
    assert result(line_dedup.clean(df, again)) == brute(rows)
    cells = {r["kind"]: bytes(r["cells"]) for r in again.filters().collect()}
    known = {k: CuckooFilter.from_bytes(c) for k, c in cells.items()}
    distinct = {key(x) for r in rows for x in (r[1] or "").split("\n")} - {None}
    assert np.count_nonzero(known["all"].cells) == len(distinct)
    shared = again.owners().count()
    assert np.count_nonzero(known["shared"].cells) == shared == len(
        [k for k in distinct if len({r[0] for r in rows if k in map(key, (r[1] or "").split("\n"))}) > 1]
    )


def test_deleting_everything_empties_the_filters(spark):
    df, _ = line_docs(spark, 30)
    index = line_dedup.insert(new_index(spark), line_dedup.line_keys(df))
    gone = line_dedup.delete(index, df.select("doc_id"))
    assert not any(any(r["cells"]) or r["keys"] for r in gone.filters().collect())
    assert gone.owners().collect() == []


def test_shards_are_divided(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MOST_KEYS", 40)
    df, rows = line_docs(spark)
    index = line_dedup.insert(new_index(spark), line_dedup.line_keys(df.where("doc_id < 15")))
    first = index.bits
    index = line_dedup.insert(index, line_dedup.line_keys(df.where("doc_id >= 15")))
    assert index.bits > first and index.filters().select("shard").distinct().count() > 2
    assert result(line_dedup.clean(df, index)) == brute(rows)
    index = line_dedup.delete(index, spark.createDataFrame([(i,) for i in range(20)], "doc_id long"))
    assert result(line_dedup.clean(df.where("doc_id >= 20"), index)) == brute([r for r in rows if r[0] >= 20])


def test_false_hits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(CuckooFilter, "contains", lambda self, hashes: np.ones(len(hashes), bool))
    df, rows = line_docs(spark, 60)
    index = line_dedup.insert(new_index(spark), line_dedup.line_keys(df.where("doc_id >= 20")))
    index = line_dedup.insert(index, line_dedup.line_keys(df.where("doc_id < 20")))
    assert result(line_dedup.clean(df, index)) == brute(rows)


def test_messy_rows(spark):
    df = stage(messy(spark), "line-docs")
    rows = [tuple(r)[:2] for r in df.collect()]
    keys = line_dedup.line_keys(df)
    index = line_dedup.insert(new_index(spark), keys)
    found = line_dedup.clean(df, index, keys)
    assert result(found) == brute(rows)
    assert found.columns == [*df.columns, "n_lines", "n_dropped"] and {r["at"] for r in found.collect()} == {"x"}
    assert set(CLASHES) < set(found.columns)
    clashing = df.withColumn("n_lines", F.lit("x")).withColumn("n_dropped", F.lit("x"))
    assert result(line_dedup.clean(clashing, index)) == brute(rows)


def test_no_rows(spark):
    keys = line_dedup.line_keys(empty(spark))
    index = line_dedup.insert(new_index(spark), keys)
    assert line_dedup.clean(empty(spark), index).collect() == []
    df, rows = line_docs(spark, 30)
    with pytest.raises(ValueError):
        line_dedup.clean(df, index, line_dedup.line_keys(df))
    index = line_dedup.insert(index, line_dedup.line_keys(df))
    assert result(line_dedup.clean(df, line_dedup.insert(index, keys))) == brute(rows)


def test_key_of():
    assert line_dedup.key_of(b" \t0123456789\r") == hashlib.blake2b(b"0123456789", digest_size=16).digest()
    assert line_dedup.key_of("Ä234567890".encode()) and line_dedup.key_of("Ä23456789".encode()) is None
    assert line_dedup.key_of(" ".encode() * 10) and line_dedup.key_of(b" " * 40) is None
    assert line_dedup.key_of(b"ABCDEFGHIJ") == line_dedup.key_of(b"abcdefghij")
