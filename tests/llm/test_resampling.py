"""Importance resampling and its radix sort against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import LONG, empty, messy, random_docs
from pyspark.sql import functions as F

from rosterflow.llm import radix, resampling
from rosterflow.session import stage

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spoken(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets(text):
    words = spoken(text)
    return [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(rows, target, percent=25, least=20, seed=7):
    here, there = Counter(), Counter()
    for r in rows:
        here.update(buckets(r[1]))
    for t in target:
        there.update(buckets(t))
    size, goal = sum(here.values()), sum(there.values())
    gain = {b: math.floor(1000 * math.log((there[b] + 1) * (size + 10000) / ((here[b] + 1) * (goal + 10000)))) for b in here}
    out = []
    for r in rows:
        found = buckets(r[1])
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        name = "" if r[0] is None else r[0]
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(found), weight, score, None, len(spoken(r[1]))])
    running = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(running[: len(running) * percent // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("percent", [0, 25, 100])
def test_against_brute_force(spark, percent):
    df, rows = random_docs(spark)
    texts = [None, "", "red green red green", "gold Gold GOLD x"]
    target = spark.createDataFrame([(t,) for t in texts], "text string")
    found = resampling.resample(df, target, percent, 15)
    assert result(found) == brute(rows, texts, percent, 15)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_messy_rows(spark):
    df = messy(spark).unionAll(messy(spark))
    rows = [tuple(r)[:2] for r in df.collect()]
    texts = ["alpha beta été", "w1x w2x"]
    target = spark.createDataFrame([(t, "x") for t in texts], "text string, bucket string")
    assert result(resampling.resample(df, target, 50, 1)) == brute(rows, texts, 50, 1)


def test_empty_tables(spark):
    df, rows = random_docs(spark, 30)
    nothing = empty(spark)
    assert resampling.resample(nothing, df).collect() == []
    assert result(resampling.resample(df, nothing.select("text"), 25, 2)) == brute(rows, [], 25, 2)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab zÄ Z09-\n😀"), max_size=60), st.integers(1, 20))
def test_features_piece_by_piece(text, size):
    before = resampling.PIECE
    resampling.PIECE = size
    try:
        found = list(resampling.features(text.encode()))
    finally:
        resampling.PIECE = before
    assert Counter(np.concatenate([f for f, _ in found]).tolist() if found else []) == Counter(buckets(text))
    assert sum(n for _, n in found) == len(spoken(text))


def test_long_text():
    parts = list(resampling.features((LONG * 7).encode()))
    assert len(parts) > 1
    assert Counter(np.concatenate([f for f, _ in parts]).tolist()) == Counter(buckets(LONG * 7))


def places(df, keys, **how):
    return {r["i"]: r["place"] for r in radix.radix_places(stage(df, "radix-test"), keys, "place", **how).collect()}


@pytest.mark.parametrize("bits,block_bits", [(1, 3), (5, 4), (12, 17), (12, 0)])
def test_radix_order(spark, bits, block_bits):
    rng = random.Random(bits)
    top = 9 if bits == 1 else (1 << 63) - 1
    values = [0, top, -top - 1] + [rng.choice([rng.randint(-5, 5), rng.randint(-top, top)]) for _ in range(60)]
    rows = [(i, v, rng.randint(0, 3)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i long, v long, w long").repartition(4)
    keys = [radix.ordered(F.col("w"), True), radix.ordered(F.col("v")), radix.ordered(F.col("i"))]
    expected = sorted(rows, key=lambda r: (-r[2], r[1], r[0]))
    assert places(df, keys, bits=bits, block_bits=block_bits) == {r[0]: p for p, r in enumerate(expected)}


def test_radix_keeps_equal_rows_in_place(spark):
    df = stage(spark.range(500).select(F.col("id").alias("i"), F.lit(3).alias("v")).coalesce(1), "equal")
    keys = [radix.ordered(F.col("v") + F.pmod("i", F.lit(2)))]
    found = {r["i"]: r["place"] for r in radix.radix_places(df, keys, "place", 2, 4).collect()}
    assert found == {i: p for p, i in enumerate([*range(0, 500, 2), *range(1, 500, 2)])}


def test_radix_without_rows_or_difference(spark):
    df = spark.createDataFrame([], "i long")
    assert places(df, [radix.ordered(F.col("i"))]) == {}
    assert places(spark.createDataFrame([(4,)], "i long"), [radix.ordered(F.col("i"))]) == {4: 0}


def test_digits_cover_varying_bits_only(spark):
    df = spark.createDataFrame([(5 << 40, 1), (5 << 40 | 6, 0)], "a long, b long")
    assert len(radix.digits_of(df, ["a", "b"], 12)) == 1
    assert len(radix.digits_of(df, ["a", "b"], 1)) == 4
