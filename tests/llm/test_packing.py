import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import COLUMNS, empty, messy
from tokenizers import Tokenizer

from rosterflow.llm import packing
from rosterflow.llm.tokens import WordEncoder

FILE = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(FILE)
ENCODER = WordEncoder(open(FILE, encoding="utf-8").read(), most=50)


def ids_of(text):
    return np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZéß.,'| \n\t\x85 ́İΣs<|>")), max_size=60))
def test_ids_equal_those_of_the_whole_text(text):
    assert ENCODER.ids(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["it's don't we'll", "<|endoftext|>a<|startoftext|>", "word! word!! (word)", "x" * 500 + " y", "Å Å ﬁ İx"])
def test_special_texts(text):
    assert ENCODER.ids(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def check(pieces, rows, length):
    """Every id in one piece, pieces gapless in sequences; returns the padding."""
    docs = defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
    wanted = defaultdict(list)
    for doc_id, text in rows:
        wanted[doc_id].append(ids_of(text))
    assert set(docs) == set(wanted)
    for doc_id, parts in docs.items():
        if len(wanted[doc_id]) == 1:
            at, ids = 0, wanted[doc_id][0]
            for p in sorted(parts, key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(ids)
                assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
                at += p["length"]
            assert at == len(ids)
        else:
            assert sum(p["length"] for p in parts) == sum(map(len, wanted[doc_id]))
    padding, sequences = 0, defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert 0 < at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


@pytest.mark.parametrize("tasks", [1, 7, 70])
def test_pieces(spark, tasks):
    rows = [(i, "red green blue " * (i * 37 % 150)) for i in range(300)]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], COLUMNS).repartition(tasks)
    pieces = packing.pack(df, FILE, length=256, open_windows=8, min_cut=8, keep_ids=False).collect()
    padding = check(pieces, rows, 256)
    assert padding < 0.03 * sum(p["length"] for p in pieces)


def test_messy_rows(spark):
    df = messy(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert check(packing.pack(df, FILE).collect(), rows, 2048) == 0
    assert packing.pack(empty(spark), FILE).collect() == []


def test_sequences_hold_the_ids(spark):
    df = messy(spark).where("doc_id IN (5, 7)").dropDuplicates(["doc_id"])
    pieces = packing.pack(df, FILE).cache()
    found = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    for p in pieces.collect():
        own = found[p["sequence_id"]]
        assert own["ids"][p["offset"] : p["offset"] + p["length"]] == np.frombuffer(p["ids"], "<u4").tolist()
        assert len(own["ids"]) == (own["tokens"] if own["tokens"].bit_count() == 1 else 2048)
    assert sum(r["tokens"] for r in found.values()) == sum(len(ids_of(r["text"])) for r in df.collect())
