import hashlib
import random

import numpy as np
import pytest
from messy import LONG, empty, messy, random_docs

from rosterflow.llm import phrases


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_equal_substrings_share_phrases_at_any_offset():
    middle = words(1, 200)
    a, b = words(2, 3) + middle + words(3, 3), "xx" + words(4, 50) + middle
    for level in range(len(phrases.LEVELS)):
        m, x, y = (set(phrases.phrase_names(t)[level].tolist()) for t in (middle, a, b))
        assert len(m & x) > 0.85 * len(m) and len(m & y) > 0.85 * len(m)


def test_texts_parsed_together_do_not_touch():
    texts = ["a", "aa", "aaaaaaaa", "ab", "ba", LONG[:500], "é\U0001f600x", "abab" * 9, words(5, 40)]
    assert phrases.fingerprints_of(texts * 3) == [phrases.fingerprint(t) for t in texts] * 3
    assert phrases.fingerprint("") == phrases.EMPTY != phrases.fingerprint("a")


def test_neighbouring_labels_differ():
    rng = np.random.default_rng(1)
    for names in (rng.integers(3, size=3000).astype(np.uint32), rng.integers(1 << 62, size=3000).astype(np.uint64)):
        first = np.array([0, 10, 11, 12, 500])
        out, first = phrases._runs(names, first)
        label = phrases._labels(out, first)
        same = np.flatnonzero(label[1:] == label[:-1]) + 1
        # only beside the start of a text may two labels agree
        assert label.max() <= 7 and set(same) <= {f + k for f in first for k in (0, 1)}


def test_likeness_estimates_shared_phrases():
    a, b = words(6, 400), words(7, 400)
    changed = phrases.edited(a, b)
    own, other, far = (phrases.fingerprint(t) for t in (a, changed, b))
    assert 0.4 < phrases.likeness(own, other) < 0.8 and phrases.likeness(own, far) < 0.1
    assert phrases.likeness(own, own) == 1 and phrases.likeness(own, phrases.EMPTY) == 0


@pytest.mark.parametrize("tasks", ["1", "3", "40"])
def test_trial_against_plain_python(spark, tasks):
    df, rows = random_docs(spark, 120)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        found = {r["doc_id"]: r for r in phrases.edit_trial(df.repartition(4)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(found) == len(rows)
    for i, (doc_id, text, *_) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        own, other, after = (phrases.fingerprint(t) for t in (text, changed, following))
        r = found[doc_id]
        assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), own, other)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert (r["near_edited"], r["near_next"]) == (phrases.likeness(own, other), phrases.likeness(own, after))


def test_messy_rows(spark):
    df = messy(spark)
    found = phrases.edit_trial(df).collect()
    assert len(found) == df.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    assert all(r["fingerprint"] == phrases.EMPTY for r in found if r["doc_id"] in (2, 3))
    assert sorted(phrases.fingerprints(df).columns) == ["doc_id", "fingerprint"]
    assert phrases.edit_trial(empty(spark)).collect() == []
    one = phrases.edit_trial(df.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1
