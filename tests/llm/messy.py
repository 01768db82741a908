"""Small tables with nulls, empty and long texts, ties, repeated rows and columns whose names clash."""

import random

from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x" for i in range(30_000))
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta.", "en", "s1"),
    (1, "Alpha beta gamma delta epsilon zeta.", "en", "s1"),
    (2, None, None, "s1"),
    (3, "", "en", None),
    (4, " \n\t\x0b", "de", "s2"),
    (None, "one two", None, None),
    (None, "one two", None, None),
    (5, LONG, "en", "s2"),
    (6, "Alphabeta gamma\ndelta epsilon  zeta.", "en", "s1"),
    (7, "ALPHA beta gamma delta epsilon zeta.", "fr", "s3"),
    (8, "été \U0001f600 <|im_end|> ß", "fr", "s3"),
    (9, "a", "es", ""),
    (-3, "one two three four", "es", "S1"),
]
#: names that operators use inside, or return
CLASHES = ["size", "key", "fingerprint", "at", "name", "hash", "part", "ids", "score", "best", "target", "source_size", "kept", "start"]


def messy(spark):
    rows = [(*r, len(r[1] or "")) for r in ROWS]
    df = spark.createDataFrame(rows, COLUMNS)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def empty(spark):
    return messy(spark).where("false")


def random_docs(spark, n=200, seed=1):
    """Texts over few words, so that copies, near copies and chance meetings occur."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("red green blue cyan pink gold".split()) for _ in range(rng.randint(0, 40))) for _ in range(n // 2)]
    for _ in range(n - len(texts)):
        words = rng.choice(texts).split(" ")
        words[rng.randrange(len(words))] = rng.choice(["red", "x", " ", ""])
        texts.append(rng.choice([" ", "  ", "\n"]).join(words))
    rows = [(i, t, "en", rng.choice(["a", "b", "c", None]), len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS), rows
