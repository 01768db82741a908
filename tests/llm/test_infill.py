"""Frames and fill-in-the-middle texts: round trips, brute force, bounded opening of frames."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from messy import empty, messy, random_docs
from pyspark.sql import functions as F

from rosterflow.llm import frames, infill


def brute(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def stored(text, size):
    data = text.encode()
    parts = list(frames.pieces(data, size))
    assert b"".join(parts) == data and all(p.decode() for p in parts)
    ends = {"bytes": [], "chars": [], "newlines": []}
    for i in range(len(parts)):
        head = b"".join(parts[: i + 1])
        for name, n in (("bytes", len(head)), ("chars", len(head.decode())), ("newlines", head.count(b"\n"))):
            ends[name].append(n)
    return frames.Frames([frames.pack(p) for p in parts], ends)


TEXTS = st.text(st.sampled_from("ab\n<PSM>é😀"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(1, 30), st.integers(0, 10_000))
def test_round_trip(text, size, doc_id):
    made = stored(text, size)
    n, form, prefix, middle, whole = brute(doc_id, text)
    assert frames.units_of(text.encode()) == n
    marked = re.search("<[PSM]>", text) is not None
    moved = infill._moved(doc_id, made, n, marked, 7, 100, 50)
    assert moved[:3] == (form, prefix, middle)
    output = frames.Frames.of(moved[3])
    assert b"".join(map(output.read, range(len(moved[3])))).decode() == whole
    assert b"".join(infill.restore(form, output)).decode() == text


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 30), st.data())
def test_bytes_by_place(text, size, data):
    made = stored(text, size)
    start = data.draw(st.integers(0, len(text.encode())))
    end = data.draw(st.integers(start, len(text.encode())))
    assert b"".join(made.stream(start, end)) == text.encode()[start:end]


def test_only_cut_frames_are_opened(monkeypatch):
    text = "".join(f"line {i} of a long text\n" for i in range(20_000))
    made = stored(text, 4096)
    opened = set()
    read = frames.Frames.read
    monkeypatch.setattr(frames.Frames, "read", lambda self, i: opened.add(i) or read(self, i))
    form, *_, output = infill._moved(5, made, 20_000, False, 7, 100, 50)
    assert len(made.frames) > 50 and len(opened) <= 2
    assert sum(f in set(made.frames) for f in output) >= len(made.frames) - 2
    monkeypatch.undo()
    held = frames.Frames.of(output)
    assert b"".join(infill.restore(form, held)).decode() == text
    assert len(held._open) <= frames.OPEN


def found(df):
    rows = infill.digests(infill.transform(infill.store(df))).collect()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    return sorted((tuple(r[c] for c in names) for r in rows), key=repr)


def expected(rows):
    sha = [(brute(r[0], r[1]), hashlib.sha256((r[1] or "").encode()).hexdigest(), r[0]) for r in rows]
    return sorted(((i, *b[:4], hashlib.sha256(b[4].encode()).hexdigest(), s) for b, s, i in sha), key=repr)


def test_against_brute_force(spark):
    df, rows = random_docs(spark)
    assert found(df) == expected(rows)
    assert {"psm", "spm", "plain"} <= {r[2] for r in found(df)}


def test_messy_rows(spark):
    df = messy(spark)
    rows = [tuple(r)[:2] for r in df.collect()]
    assert found(df) == expected(rows)
    clashing = df.select("*", *[F.lit("x").alias(c) for c in ("frames", "n", "marked", "form", "output", "output_sha256")])
    assert found(clashing) == expected(rows)
    assert found(empty(spark)) == []
    kept = infill.digests(infill.transform(infill.store(df)))
    assert set(df.columns) - {"text"} <= set(kept.columns) and {r["key"] for r in kept.collect()} == {"x"}


@pytest.mark.parametrize("rate,spm", [(0, 50), (40, 0), (100, 100)])
def test_rates(spark, rate, spm):
    df, rows = random_docs(spark, 120)
    out = infill.texts(infill.transform(infill.store(df), 3, rate, spm)).collect()
    assert {(r["doc_id"], r["form"], r["text"]) for r in out} == {
        (r[0], b[1], b[4]) for r in rows for b in [brute(r[0], r[1], 3, rate, spm)]
    }


def test_a_text_of_many_frames(spark):
    rng = random.Random(1)
    text = "".join(rng.choice(["é", "a", "\n", "<", "P", ">x"]) for _ in range(300_000)).replace("<P>", "")
    one_line = "z😀" * 200_000
    df = spark.createDataFrame([(1, text), (2, one_line), (3, "<M>" + text)], "doc_id long, text string")
    assert found(df) == expected([tuple(r) for r in df.collect()])
    sizes = infill.store(df).selectExpr("max(size(frames)) AS n").first()["n"]
    assert sizes > 10
