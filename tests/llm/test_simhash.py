import random

import numpy as np
import pytest
import xxhash
from messy import empty, messy, random_docs
from pyspark.sql import functions as F

from rosterflow.llm import components, simhash


def plain(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if near(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", "A", "Ab cd", "a b c", "ÉTÉ a B c d", "x y z " * 500, "one two three four " * 7 + "end"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_matches_the_built_in_hash(spark):
    text = "red green blue"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64) == simhash.fingerprint(text)


def test_components_against_all_pairs(spark):
    df, rows = random_docs(spark, 160)
    prints = {r[0]: plain(r[1]) for r in rows}
    least = classes(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    found = simhash.near_duplicates(df).collect()
    assert {r["doc_id"]: r["fingerprint"] % (1 << 64) for r in found} == prints
    assert {r["doc_id"]: r["component_id"] for r in found} == least
    assert any(d != c for d, c in least.items())


@pytest.mark.parametrize("blocks", [4, 5, 6, 7])
def test_links_lose_none(spark, blocks):
    rng = random.Random(blocks)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for n in (1, 2, 3, 4):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), n)))
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    found = [(r["a"], r["b"]) for r in simhash.links(df, blocks=blocks).collect()]
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3}
    assert len(found) == len(set(found)) and set(found) == near


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1050)] + [(7000, 6999), (5, 5)]
    found = components.smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {
        **{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1050)}, 7000: 6999, 6999: 6999
    }
    assert components.smallest_reachable(spark.createDataFrame([], "a long, b long")).collect() == []


def test_messy_rows(spark):
    df = messy(spark)
    found = simhash.near_duplicates(df).collect()
    assert len(found) == df.count()
    blank = [r for r in found if r["doc_id"] in (2, 3, 4)]
    assert all(r["fingerprint"] == 0 and r["component_id"] == 2 for r in blank)
    assert all(r["component_id"] is None for r in found if r["doc_id"] is None)
    assert all(r["component_id"] == 1 for r in found if r["doc_id"] in (1, 7))
    stays = simhash.drop_near_duplicates(df)
    assert stays.columns == df.columns
    ids = sorted(r["doc_id"] for r in stays.where("doc_id IS NOT NULL").collect())
    assert ids == [-3, 1, 2, 5, 6, 8, 9] and stays.where("doc_id IS NULL").count() == 1
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.drop_near_duplicates(empty(spark)).collect() == []
