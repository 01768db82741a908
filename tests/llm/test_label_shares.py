"""Toxicity learns the same probabilities from samples whose label ratio differs from that of the table."""

import random

import numpy as np

from rosterflow.llm import toxicity


def test_a_smaller_sample_leaves_the_probabilities(spark, monkeypatch):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        toxic = int(i % 10 == 0)
        marked = rng.random() < (0.7 if toxic else 0.1)
        own = "".join("abcdefghij"[int(c)] for c in str(i))
        rows.append((i, f"nice day {'awful' if marked else 'sunny'} {own}", toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    texts = ["awful", "sunny"]

    def probabilities():
        model = toxicity.fit(docs, labels, grades=1)
        weigh = toxicity._Weights(model)
        return model.above(np.array([weigh.value(t) for t in texts]))[:, 0]

    whole = probabilities()
    monkeypatch.setattr(toxicity, "MOST_PER_LABEL", 290)
    assert np.allclose(probabilities(), whole, atol=0.08)
