"""Quality, language, toxicity and pseudo-likelihood: held-out accuracy, exact parts, odd inputs."""

from zlib import crc32

import numpy as np
import pytest
from messy import LONG, empty, messy
from pyspark.sql import functions as F

from rosterflow.llm import language, pseudo, quality, toxicity
from rosterflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet").cache()
    return docs, labels


def test_quality_on_held_out_rows(spark, tables):
    found = QUERIES["op9_quality"](spark, SF).toPandas()
    assert len(found) == tables[0].count() and found["score"].between(0, 1).all()
    assert all(h == (crc32(str(d).encode()) % 5 == 0) for d, h in zip(found["doc_id"], found["held_out"]))
    assert ((found["score"] >= 0.3) == (found["predicted"] == 1)).all()
    held = found[found["held_out"]].merge(tables[1].toPandas(), on="doc_id")
    assert len(held) > 50 and (held["predicted"] == held["quality"]).mean() > 0.97
    assert held[held["quality"] == 1]["predicted"].mean() > 0.99


def test_every_character_of_a_long_word_counts():
    def bag(text):
        numbers, weights = quality.features(text)
        return dict(zip(numbers.tolist(), weights.tolist()))

    head = "Ab1" * 90
    one, other = bag(head + "QUALITY9" * 50), bag(head + "zzz@@" * 50)
    words = [{n: w for n, w in b.items() if n < quality.WORDS} for b in (one, other)]
    shapes = [{n: w for n, w in b.items() if n >= quality.WORDS} for b in (one, other)]
    assert words[0] != words[1] and shapes[0] != shapes[1]
    # a word weighs as much in stretches as in one
    for found in words:
        assert sum(found.values()) == pytest.approx(1)
    for b in (one, other, bag("plain words here"), bag("x" * 40 + " y")):
        assert sum(w for n, w in b.items() if n < quality.WORDS) == pytest.approx(1)
    lines = [f"{i:04d}{chr(0x4E00 + i)}" for i in range(600)]
    assert bag("".join(lines)) != bag("".join(lines[:-1] + ["x"]))
    assert len(bag("".join(lines))) > 300


def test_quality_votes_against_all_neighbours(tables):
    docs, labels = tables
    model = quality.fit(docs, labels, quality.train_rows())
    texts = [r["text"] for r in docs.limit(40).collect()]
    vectors = model.project([quality.features(t) for t in texts])
    for text_score, vector in zip(model.scores(texts), vectors):
        like = sorted(zip((model.vectors @ vector).tolist(), model.labels), reverse=True)[: quality.NEIGHBOURS]
        pull = [max(0, s) for s, _ in like]
        vote = sum(p * y for p, (_, y) in zip(pull, like)) + quality.PRIOR_WEIGHT * model.prior
        assert text_score == pytest.approx(vote / (sum(pull) + quality.PRIOR_WEIGHT), abs=1e-3)


def test_quality_learns_from_train_rows_only(spark, tables):
    docs, labels = tables
    wrong = labels.withColumn("quality", F.when(quality.train_rows(), F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (quality.fit(docs, t, quality.train_rows()) for t in (labels, wrong))
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.labels, b.labels)
    assert len(quality.fit(docs, labels, most=50).labels) == 50


def test_quality_of_messy_rows(spark, tables):
    df = messy(spark)
    model = quality.fit(*tables)
    found = quality.score(df, model).collect()
    assert len(found) == df.count() and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["score"] == pytest.approx(model.prior) for r in found if r["doc_id"] in (2, 3, 4))
    assert quality.keep_good(df, model).columns == df.columns
    assert quality.keep_good(df, model).count() == sum(r["score"] >= 0.3 for r in found)
    none = quality.fit(tables[0], tables[1].where("false"))
    assert {r["score"] for r in quality.score(df, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, None, 1), (None, 1, 0), (5, 1, 0), (5, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.fit(df, odd).labels.tolist() == [0.5]
    assert quality.score(empty(spark), model).collect() == []


def test_language_on_held_out_rows(spark, tables):
    found = QUERIES["op10_language_id"](spark, SF).toPandas()
    assert len(found) == tables[0].count() and found["score"].between(0, 1).all()
    assert all(h == (crc32(str(d).encode()) % 3 == 1) for d, h in zip(found["doc_id"], found["held_out"]))
    held = found[found["held_out"]].merge(tables[0].select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(held) > 200 and (held["lang_pred"] == held["lang"]).mean() > 0.99


def test_codewords_are_apart():
    for n in (1, 2, 3, 4, 5, 9, 30):
        codes = language.codewords(n)
        assert codes.shape[0] == n and set(np.unique(codes)) <= {-1.0, 1.0}
        apart = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
        assert not apart or min(apart) >= max(1, codes.shape[1] // 4)


def test_language_of_messy_rows(spark, tables):
    df = messy(spark).unionByName(messy(spark).limit(1).withColumn("text", F.lit("123 你好 !")).withColumn("doc_id", F.lit(70)))
    model = language.fit(tables[0])
    found = language.identify(df, model).collect()
    assert len(found) == df.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in found if r["doc_id"] in (2, 3, 4))
    assert {r["lang_pred"] for r in found if r["doc_id"] not in (2, 3, 4)} <= {"en", "de", "fr", "es"}
    nothing = language.fit(tables[0], F.lit(False))
    assert {r["lang_pred"] for r in language.identify(df, nothing).collect()} == {"und"}
    one = language.fit(tables[0], F.col("lang") == "de")
    assert {r["lang_pred"] for r in language.identify(df.where("doc_id = 8"), one).collect()} == {"de"}
    assert language.identify(empty(spark), model).collect() == []


def test_toxicity_on_held_out_rows(spark, tables):
    found = QUERIES["op3_toxicity"](spark, SF).toPandas()
    assert len(found) == tables[0].count() and found["severity"].between(0, 3).all()
    held = found[found["held_out"]].merge(tables[1].toPandas().rename(columns={"toxic": "label"}), on="doc_id")
    assert held[held["label"] == 0]["toxic"].mean() < 0.02 and held[held["label"] == 1]["toxic"].mean() > 0.6
    severity = held.groupby("label")["severity"].mean()
    assert severity[1] > 10 * severity[0]


def test_toxicity_shares_weights_across_thresholds(spark):
    rows = [(i, "nice day " + "bad " * (i % 4 > 0) + "worse " * (i % 4 > 1) + "worst" * (i % 4 > 2) + " " + "".join("abcdefghij"[int(c)] for c in str(i))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), i % 4) for i, _ in rows], "doc_id long, toxic int, level int")
    model = toxicity.fit(docs, labels, grade="level")
    assert len(model.thresholds) == 3 and (np.diff(model.thresholds) > 0).all()
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert np.mean([found[i]["grade"] == i % 4 for i, _ in rows]) > 0.95
    # severity is the sum of the probabilities of all thresholds under one linear value
    weigh = toxicity._Weights(model)
    for i, text in rows[:8]:
        expected = sum(1 / (1 + np.exp(t - weigh.value(text))) for t in model.thresholds)
        assert found[i]["severity"] == pytest.approx(expected)


def test_toxicity_of_messy_rows(spark, tables):
    df = messy(spark).withColumn("grade", F.lit("x")).withColumn("toxic", F.lit("x"))
    model = toxicity.fit(*tables)
    found = toxicity.score(df, model).collect()
    assert len(found) == df.count() and not any(r["toxic"] for r in found)
    none = toxicity.fit(tables[0], tables[1].where("toxic = 0"))
    assert all(r["severity"] < 1e-6 for r in toxicity.score(df, none).collect())
    assert toxicity.score(empty(spark), model).collect() == []
    assert not toxicity.fit(tables[0], tables[1].where("false")).weights


@pytest.fixture(scope="module")
def language_model(tables):
    counts = pseudo.count(tables[0])
    return counts, pseudo.train(pseudo.encode(tables[0], counts), counts)


def test_counts_cover_all_documents(tables, language_model):
    from collections import Counter

    plain = Counter(w for r in tables[0].collect() for w in pseudo.tokens_of(r["text"] or ""))
    assert {r["word"]: r["n"] for r in pseudo.word_counts(tables[0]).collect()} == plain
    top = sorted(plain, key=lambda w: (-plain[w], w))[: pseudo.VOCABULARY]
    assert language_model[0].vocabulary == top
    # shares within a class sum up to one
    sums = np.bincount(language_model[0].group, np.exp(language_model[0].within), pseudo.CLASSES)
    assert np.allclose(sums[sums > 0], 1)


def test_scores_against_plain_sums(spark, tables, language_model):
    counts, network = language_model
    docs = tables[0].where("doc_id < 6")
    found = {r["doc_id"]: r for r in pseudo.score(pseudo.encode(docs, counts), counts, network).collect()}
    numbers = pseudo._Numbers(counts.vocabulary)
    for r in docs.collect():
        symbols, total = numbers.symbols(r["text"]), 0.0
        for i, s in enumerate(symbols[:]):
            summed, k = network.bias[0].copy(), 0
            for j in range(-pseudo.SIDE, pseudo.SIDE + 1):
                if j:
                    near = symbols[i + j] if 0 <= i + j < len(symbols) else pseudo.EDGE
                    summed += network.table[k * pseudo.SYMBOLS + near]
                    k += 1
            logits = np.tanh(summed) @ network.out + network.prior[0]
            total += logits[counts.group[s]] - np.log(np.exp(logits).sum()) + counts.within[s]
        assert found[r["doc_id"]]["n_tokens"] == len(symbols)
        assert found[r["doc_id"]]["log_likelihood"] == pytest.approx(total, rel=1e-3)


def test_both_sides_help(tables, language_model):
    counts, network = language_model
    numbers, rng = pseudo._Numbers(counts.vocabulary), np.random.default_rng(0)
    texts = [numbers.symbols(r["text"]) for r in tables[0].limit(200).collect()]
    own = sum(pseudo.pseudo_likelihood(network, counts, s) for s in texts)
    mixed = sum(pseudo.pseudo_likelihood(network, counts, rng.permutation(s)) for s in texts)
    blank = sum(pseudo.pseudo_likelihood(pseudo.Network(), counts, s) for s in texts)
    assert own > mixed and own > blank


def test_averaging_is_the_mean_of_the_tasks(spark, tables):
    docs = tables[0].where("doc_id < 60")
    counts = pseudo.count(docs)
    encoded = pseudo.encode(docs, counts).repartition(3, "doc_id").cache()
    network = pseudo.train(encoded, counts).vector()
    own, weight = [], []
    for rows in encoded.rdd.glom().collect():
        documents = [np.frombuffer(r["symbols"], "<u2").astype(np.int64) for r in rows]
        if documents:
            own.append(pseudo._trained(iter(documents), counts).vector())
            weight.append(sum(map(len, documents)))
    assert len(own) == 3 and np.allclose(network, np.average(own, axis=0, weights=weight), atol=1e-5)


def test_pseudo_likelihood_of_messy_rows(spark, language_model):
    df = messy(spark)
    counts = language_model[0]
    found = pseudo.score(pseudo.encode(df, counts), *language_model).collect()
    assert len(found) == df.count()
    blank = [r for r in found if r["doc_id"] in (2, 3, 4)]
    assert all((r["n_tokens"], r["log_likelihood"], r["mean_log_likelihood"]) == (0, 0, None) for r in blank)
    assert {r["n_tokens"] for r in found if r["doc_id"] == 5} == {len(LONG.split())}
    assert pseudo.score(pseudo.encode(empty(spark), counts), *language_model).collect() == []
    nothing = pseudo.count(empty(spark))
    network = pseudo.train(pseudo.encode(empty(spark), nothing), nothing)
    assert pseudo.score(pseudo.encode(df, nothing), nothing, network).count() == df.count()
