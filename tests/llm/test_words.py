"""Pseudo-likelihood of words: those outside the vocabulary count with their own counts, the network predicts the others."""

from collections import Counter
from math import log
from zlib import crc32

import numpy as np
import pytest
from messy import empty, messy
from pyspark.sql import functions as F

from rosterflow.llm import pseudo

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    words = pseudo.word_counts(docs).cache()
    counts = pseudo.count(docs, words)
    return docs, words, counts, pseudo.train(pseudo.encode(docs, counts), counts)


def test_words_outside_the_vocabulary_have_their_own_share(spark, model):
    docs, words, counts, network = model
    plain = Counter(w for r in docs.collect() for w in pseudo.tokens_of(r["text"] or ""))
    known = set(counts.vocabulary)
    bucket = {w: crc32(w.encode()) % pseudo.OTHERS for w in plain if w not in known}
    assert bucket
    tokens, kinds = Counter(), Counter(bucket.values())
    for w, b in bucket.items():
        tokens[b] += plain[w]
    some = docs.where("doc_id < 20")
    encoded = pseudo.encode(some, counts).cache()
    numbers = pseudo._Numbers(counts.vocabulary)
    by_bucket = {r["doc_id"]: pseudo.word_likelihood(network, counts, numbers.symbols(r["text"])) for r in some.collect()}
    found = {r["doc_id"]: r["log_likelihood"] for r in pseudo.score(encoded, counts, network, words).collect()}
    parts = {}
    for r in some.collect():
        own = [w for w in pseudo.tokens_of(r["text"]) if w not in known]
        parts[r["doc_id"]] = sum(log(plain[w] / (tokens[bucket[w]] + 1)) for w in own)
    assert min(parts.values()) < 0
    assert {d: found[d] - by_bucket[d] for d in found} == pytest.approx(parts, abs=1e-3)
    assert all(kinds[b] == counts.kinds[b] and tokens[b] == counts.tokens[b] for b in range(pseudo.OTHERS))


def test_gibberish_scores_below_rare_words(spark, model):
    docs, words, counts, network = model
    known = set(counts.vocabulary)
    rare = {}
    for r in words.where("n = 1").collect():
        if r["word"] not in known:
            rare.setdefault(crc32(r["word"].encode()) % pseudo.OTHERS, r["word"])
    # words never seen, each in the bucket of a rare one, so that the network sees the same
    wanted, i = {}, 0
    while len(wanted) < 5:
        word = f"xq{i}zzv"
        b = crc32(word.encode()) % pseudo.OTHERS
        if b in rare:
            wanted[b] = word
        i += 1
    texts = [" ".join(rare[b] for b in wanted), " ".join(wanted.values()), " ".join(counts.vocabulary[:5]), None, ""]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string")
    found = pseudo.score(pseudo.encode(df, counts), counts, network, words).collect()
    scores = {r["doc_id"]: r["mean_log_likelihood"] for r in found}
    assert len(found) == 6 and len({r["log_likelihood"] for r in found if r["doc_id"] == 0}) == 1
    assert scores[1] < scores[0] - 1 and scores[0] < scores[2]
    assert scores[3] is None and scores[4] is None


def test_context_tells_words_of_one_class_apart(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1500):
        a, b = (("ants", "bone"), ("zebras", "milk"))[i % 2]
        rows.append((i, " ".join(f"{a} want {b} {rng.choice(['now', 'today'])}" for _ in range(6))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    words = pseudo.word_counts(docs).cache()
    counts = pseudo.count(docs, words)
    network = pseudo.train(pseudo.encode(docs, counts), counts)
    numbers = pseudo._Numbers(counts.vocabulary)
    right, wrong = numbers.symbols("ants want bone now"), numbers.symbols("ants want milk now")
    assert counts.group[right[2]] == counts.group[wrong[2]]  # equally frequent, so of one class

    def at_its_place(symbols):
        return network.word_log_probabilities(network.windows(symbols)[2:3], symbols[2:3], counts)[0]

    assert at_its_place(right) > at_its_place(wrong) + 1
    # the probabilities of all symbols at a position sum up to one
    window = np.repeat(network.windows(right)[2:3], pseudo.SYMBOLS, axis=0)
    total = np.exp(network.word_log_probabilities(window, np.arange(pseudo.SYMBOLS), counts).astype(float)).sum()
    assert total == pytest.approx(1, abs=1e-3)
    df = spark.createDataFrame([(0, "ants want bone now"), (1, "ants want milk now")], "doc_id long, text string")
    found = {r["doc_id"]: r["log_likelihood"] for r in pseudo.score(pseudo.encode(df, counts), counts, network, words).collect()}
    assert found[0] > found[1]


def test_predicted_words_beat_their_corpus_shares(model):
    docs, _, counts, network = model
    numbers = pseudo._Numbers(counts.vocabulary)
    texts = [numbers.symbols(r["text"]) for r in docs.limit(200).collect()]
    predicted = sum(pseudo.word_likelihood(network, counts, s) for s in texts)
    assert predicted > sum(pseudo.pseudo_likelihood(network, counts, s) for s in texts)


def test_messy_rows_by_word(spark, model):
    _, words, counts, network = model
    df = messy(spark)
    numbers = pseudo._Numbers(counts.vocabulary)
    shares = {r["word"]: r["n"] for r in words.collect()}
    found = pseudo.score(pseudo.encode(df, counts), counts, network, words).collect()
    assert len(found) == df.count()
    expected = []
    for doc_id, text in [(r["doc_id"], r["text"]) for r in df.collect()]:
        own = pseudo.tokens_of(text or "")
        total = pseudo.word_likelihood(network, counts, numbers.symbols(own))
        for w in own:
            if w not in set(counts.vocabulary):
                b = crc32(w.encode()) % pseudo.OTHERS
                part = -log(counts.kinds[b] + 1) if w not in shares else log(shares[w])
                total += part - log(counts.tokens[b] + 1)
        expected.append((doc_id, len(own), total))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], r["n_tokens"], r["log_likelihood"]) for r in found), key=order)
    for a, b in zip(got, sorted(expected, key=order)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-4, abs=1e-3)
    assert pseudo.score(pseudo.encode(empty(spark), counts), counts, network, words).collect() == []


def test_listed_words_count_as_joined_ones(spark, model, monkeypatch):
    docs, words, counts, network = model
    df = messy(spark).unionByName(docs.select("doc_id", "text").where("doc_id < 40"), allowMissingColumns=True)
    outside = {r["word"] for r in words.collect()} - set(counts.vocabulary)
    scores, joined = [], []
    for most in (0, 300, len(outside) // 2, pseudo.LISTED):
        monkeypatch.setattr(pseudo, "LISTED", most)
        own = pseudo.count(docs, words)
        assert own.vocabulary == counts.vocabulary and len(own.listed) <= most and set(own.listed) <= outside
        encoded = pseudo.encode(df, own)
        rest = encoded.select(F.explode("rest.word").alias("word")).collect()
        assert not {r["word"] for r in rest} & ({*own.listed} | {*own.vocabulary})
        joined.append(len(rest))
        found = pseudo.score(encoded, own, network, words).collect()
        scores.append(sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["log_likelihood"]) for r in found))
    assert len(scores[0]) == df.count() and all(s == scores[0] for s in scores)
    # all words of so small a corpus are listed but long ones, so that only these and unseen ones are left to the join
    assert set(own.listed) == {w for w in outside if len(w) <= pseudo.LONGEST} and joined[0] > joined[2] > joined[3]


def test_moves_of_the_table_are_plain_sums():
    rng = np.random.default_rng(6)
    network, windows = pseudo.Network(), np.arange(2 * pseudo.SIDE) * pseudo.SYMBOLS + rng.integers(90, size=(4000, 1)) ** 2
    moves, before = rng.normal(size=(4000, pseudo.HIDDEN)).astype(np.float32), network.table.astype(float)
    network._step_table(moves, windows)
    times = np.bincount(windows.ravel(), minlength=len(before))
    for row in np.unique(windows):
        own = moves[(windows == row).any(axis=1)].astype(float).sum(axis=0)
        before[row] += own * min(1, pseudo.OFTEN / times[row])
    assert np.allclose(network.table, before, atol=1e-5)


def test_large_logits_do_not_overflow():
    x = np.array([[1.0, 200.0, -5.0]], np.float32)
    assert np.isfinite(pseudo._exp(x.copy())).all() and np.array_equal(pseudo._exp(x.copy())[:, [0, 2]], np.exp(x[:, [0, 2]]))
    counts = pseudo.Counts([], np.arange(pseudo.SYMBOLS) % pseudo.CLASSES, np.zeros(pseudo.SYMBOLS), *np.zeros((2, pseudo.OTHERS), int))
    network = pseudo.Network()
    assert network._safe(counts)
    network.words[5] = 30
    assert network._safe() and not network._safe(counts)
    symbols = np.arange(50)
    assert np.isfinite(network.word_log_probabilities(network.windows(symbols), symbols, counts)).all()
    network.out[:, 3] = 30
    assert not network._safe()
    assert np.isfinite(network.log_probabilities(network.windows(symbols), counts.group[symbols])).all()


def test_slices_cover_every_position():
    rng = np.random.default_rng(2)
    documents = [rng.integers(pseudo.VOCABULARY, size=n) for n in (0, 1, 2, 7, 40, 0, 3, 19)]
    for most in (1, 2, 5, 16, 1000):
        parts = list(pseudo._slices(documents, most))
        assert np.array_equal(np.concatenate([p.symbols for p in parts]), np.concatenate(documents))
        owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
        assert np.array_equal(np.concatenate([p.owner for p in parts]), owner)
        assert max(len(p.symbols) for p in parts) < 2 * most + max(most, 1)
        windows = np.concatenate([p.windows for p in parts])
        at = 0
        for d in documents:
            padded = [pseudo.EDGE] * pseudo.SIDE + d.tolist() + [pseudo.EDGE] * pseudo.SIDE
            for i in range(len(d)):
                near = [padded[i + k] for k in range(2 * pseudo.SIDE + 1) if k != pseudo.SIDE]
                assert windows[at].tolist() == [n + j * pseudo.SYMBOLS for j, n in enumerate(near)]
                at += 1
