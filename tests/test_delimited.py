"""Records of CSV files against a sequential reader, over many splits, with long values and stray quotes."""

import random
import re

import pytest

from rosterflow.sources.applicants import scan_applicants
from rosterflow.sources.delimited import column, read_delimited, scan_lines

LETTER = re.compile(r'(?<=[^,"\n])"(?=[^,"\n])')


def quotes(text):
    return LETTER.sub("", text).count('"')


def close(text, at):
    """Place of the quote that closes a value whose inside begins at ``at``."""
    while True:
        at = text.find('"', at)
        if at < 0 or text[at + 1 : at + 2] != '"':
            return at
        at += 2


def whole(text):
    """Values of a text if all are whole, and whether a last one stays open; None if a quote stands wrong."""
    out = []
    while True:
        if text.startswith('"'):
            end = close(text, 1)
            if end < 0:
                return out, True
            value, rest = text[: end + 1], text[end + 1 :]
            if rest and rest[0] != ",":
                return None
        else:
            cut = text.find(",")
            value, rest = (text, "") if cut < 0 else (text[:cut], text[cut:])
        out.append(value)
        if not rest:
            return out, False
        text = rest[1:]


def opens(line):
    found = whole(line)
    return len(found[0]) if found and found[1] else None


def after(line, is_open):
    """Whole values behind the quote that closes a value open from before, if the rest ends as ``is_open`` says."""
    end = close(line, 0)
    if end < 0:
        return None
    rest = line[end + 1 :]
    if not rest:
        return None if is_open else 0
    found = whole(rest[1:]) if rest[0] == "," else None
    return len(found[0]) if found and found[1] == is_open else None


def sequential(text):
    """Records in order. A line that opens a value takes lines up to the next with an odd number of quotes, if those fit."""
    lines = text.split("\n")
    bare = [x.removesuffix("\r") for x in lines]
    odd = [quotes(x) % 2 == 1 for x in bare]
    start = next((i for i, x in enumerate(bare) if x.strip(" ")), None)
    out, need, i = [], None, 0
    if start is not None and not odd[start]:
        need = len(split(bare[start])[0])
    while i < len(lines):
        last, count = i, opens(bare[i]) if odd[i] else None
        if count is not None:
            for j in range(i + 1, len(lines)):
                if odd[j]:
                    tail = after(bare[j], False)
                    if tail is not None and (count + 1 + tail == need or i == start):
                        last = j
                        if i == start:
                            need = count + 1 + tail
                    break
                if re.fullmatch(r'(?:[^"]|"")*', bare[j]) is None:
                    more = after(bare[j], True)
                    if more is None:
                        break
                    count += more + 1
        record = "\n".join(lines[i : last + 1]).removesuffix("\r")
        if record.strip(" "):
            out.append(record)
        i = last + 1
    return out


def split(record):
    """(values, fits) of a record, as its quotes say."""
    found = whole(record)
    if found is None or found[1] or quotes(record) % 2:
        return [], False
    return [v[1:-1].replace('""', '"') if len(v) > 1 and v[0] == v[-1] == '"' else v for v in found[0]], True


def random_file(rng, stray):
    """A heading of three columns and records, some with line breaks, doubled quotes, blank lines, and stray quotes."""
    words = ["a", "b c", "", "x,y", 'say ""no""', "1\n2", "\n", "p\n\nq", 'u""\nv', "end\r", 'in 5"x']
    rows = ["id,name,note"]
    for i in range(rng.randint(0, 25)):
        cells = [str(i)]
        for _ in range(2):
            word = rng.choice(words)
            quoted = any(c in word for c in ',\n') or '""' in word or rng.random() < 0.2
            cells.append(f'"{word}"' if quoted else word.replace('"', "") if '5"x' not in word else word)
        row = ",".join(cells)
        if rng.random() < stray:
            at = rng.randrange(len(row) + 1)
            row = row[:at] + rng.choice(['"', '""', ',"']) + row[at:]
        rows.append(row)
        if rng.random() < 0.1:
            rows.append("")
    return rng.choice(["\n", "\r\n"]).join(rows) + rng.choice(["", "\n"])


@pytest.mark.parametrize("seed,size", [(1, 16), (2, 60), (3, 100_000)])
def test_against_a_sequential_reader(spark, tmp_path, seed, size):
    rng = random.Random(seed)
    texts = {f"f{i}.csv": random_file(rng, rng.choice([0, 0.1, 0.4])) for i in range(12)}
    texts["heading.csv"] = 'id,"na\nme",note\n1,"x\ny",z\n2,a,b\n'
    texts["open.csv"] = 'id,name,note\n1,"never closed,x\n' + "".join(f"{i},n,x\n" for i in range(60))
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = scan_lines(spark, str(tmp_path))
    finally:
        for key, value in zip(("maxPartitionBytes", "openCostInBytes"), before):
            spark.conf.set(f"spark.sql.files.{key}", value)
    if size == 16:
        assert lines.where("src_file LIKE '%open.csv'").select("src_block").distinct().count() > 20
    good, rejects = read_delimited(lines, ["id"], "t")
    found = {(r["src_file"].rsplit("/")[-1], tuple(r["fields"])) for r in good.collect()}
    bad = sorted((r["src_file"].rsplit("/")[-1], r["record"], r["reason"]) for r in rejects.collect())
    expected, wrong = set(), []
    for name, text in texts.items():
        head, *records = sequential(text) or [""]
        for record in records:
            values, fits = split(record)
            if fits and len(values) == len(split(head)[0]):
                expected.add((name, tuple(None if v in ("", "N/A") else v for v in values)))
            else:
                why = "quotes do not match" if not fits else "too few values" if len(values) < 3 else "too many values"
                wrong.append((name, record, why))
    assert found == expected
    assert bad == sorted(wrong)
    assert any("\n" in (v or "") for _, f in found for v in f) and bad


@pytest.mark.parametrize("length", [3_000, 10_000_000])
def test_long_quoted_value(spark, tmp_path, length):
    value = ("ab\n" * (length // 3)) + '""' * 2000
    (tmp_path / "Talent").mkdir()
    (tmp_path / "Talent" / "a.csv").write_text(f'id,name,address\n1,Ann,"{value}"\n2,Ben,"{"z" * length}"\n3,Cy,x\n')
    rows, rejects = scan_applicants(spark, str(tmp_path))
    assert {r["id"]: r["address"] for r in rows.collect()} == {1: value.replace('""', '"'), 2: "z" * length, 3: "x"}
    assert rejects.collect() == []


def test_one_stray_quote_costs_one_line(spark, tmp_path):
    (tmp_path / "Talent").mkdir()
    lines = ["id,name,address", '0,"Ann,x', *[f'{i},"N{i}","a ""b""\n{i}"' for i in range(1, 50)]]
    (tmp_path / "Talent" / "a.csv").write_text("\n".join(lines) + "\n")
    rows, rejects = scan_applicants(spark, str(tmp_path))
    assert sorted((r["id"], r["address"]) for r in rows.collect()) == [(i, f'a "b"\n{i}') for i in range(1, 50)]
    assert [(r["record"], r["reason"]) for r in rejects.collect()] == [('0,"Ann,x', "quotes do not match")]


def test_column_by_heading(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿NOTE, Id\nx,1\n")
    good, _ = read_delimited(scan_lines(spark, str(tmp_path)), ["id"], "t")
    row = good.select(column("id").alias("id"), column("note").alias("note"), column("none").alias("none")).first()
    assert tuple(row) == ("1", "x", None)


def test_values_are_those_of_the_plain_patterns(spark):
    """Lines without quotes are split and a return is cut without a pattern; the values are as with them."""
    from pyspark.sql import functions as F

    from rosterflow.sources import delimited as D

    texts = ["", ",", "a,b", "a,,", 'a,"b,c",d', '"a""b",c', 'a"b"c,d', 'a"b",c', "x\r", "x\r\r", "\r", '\U0001f600"y,z', 'a"b"c"d', '"', '""', "a\nb,c", 'x,"\n']
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    letter = r'(?<=[^,"\n])"(?=[^,"\n])'
    plain = F.regexp_replace("v", letter, "")
    old = [
        F.regexp_replace("v", r"\r\z", ""),
        F.regexp_extract_all(F.concat(F.lit(","), F.col("v")), F.lit(D._VALUE), F.lit(1)),
        F.char_length(plain) - F.char_length(F.replace(plain, F.lit('"'), F.lit(""))),
    ]
    new = [D._line(F.col("v")), D._values(F.col("v")), D._quotes(F.col("v"))]
    pairs = rows.select("v", F.struct(*old).alias("old"), F.struct(*new).alias("new")).collect()
    assert all(tuple(r["old"]) == tuple(r["new"]) for r in pairs)
