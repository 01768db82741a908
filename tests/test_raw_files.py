"""Readers and the whole load on small raw files."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from raw_files import write_raw
from rosterflow.plans.applicants import applicant_tables, applicants_since
from rosterflow.plans.assessments import interview_results, tech_by_assessment
from rosterflow.plans.appending import LEDGER
from rosterflow.plans.star import COLUMNS, audit_star, build_star, unlinked_trainees
from rosterflow.plans.talent import merged_talent, talent_tables
from rosterflow.sinks.tables import append_candidates, export_csv, export_tables, read_star, write_star
from rosterflow.sources.academy import read_academy, scan_academy
from rosterflow.sources.applicants import read_applicants, scan_applicants
from rosterflow.sources.files import file_reader, list_files, read_csv
from rosterflow.sources.reports import read_assessment_reports
from rosterflow.sources.talent import read_talent_json, shred_talent
from rosterflow.session import stage
from rosterflow.streaming.incremental import run_applicant_updates


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    return write_raw(tmp_path_factory.mktemp("raw") / "files")


@pytest.fixture(scope="module")
def star(spark, raw):
    return {name: stage(df, name) for name, df in build_star(spark, raw)[0].items()}


def test_applicants(spark, raw):
    rows = {r.applicant_id: r for r in read_applicants(spark, raw)[0].collect()}
    assert set(rows) == {
        "adaotest20190410",
        "bendemocase20190400",
        "cysample20190400",
        "deeback\\slash20190400",
        "eveearly00000000",
        "adaotest20190905",
    }
    ada = rows["adaotest20190410"]
    assert (ada.phone_number, ada.dob, ada.invited_date) == ("+44-718-555-0101", dt.date(1994, 8, 4), dt.date(2019, 4, 10))
    cy = rows["cysample20190400"]
    assert (cy.uni, cy.address) == ('Uni "B", north', None)
    assert rows["eveearly00000000"].dob is None and rows["eveearly00000000"].dob_unreadable
    assert rows["deeback\\slash20190400"].day_missing and rows["eveearly00000000"].date_missing


def test_talent_json(spark, raw):
    records, rejects = read_talent_json(spark, raw)
    keys = {r.json_key: r for r in records.collect()}
    assert set(keys) == {10383, 9999, 11000, 12000}
    assert keys[10383].date == dt.date(2019, 5, 1) and keys[10383].person_id == "adaotest20190501"
    assert keys[11000].person_id is None
    assert [os.path.basename(r.src_file) for r in rejects.collect()] == ["77.json"]
    parts = shred_talent(records)
    assert "strengths" not in parts["core"].columns
    assert {r.json_key: r.self_development for r in parts["core"].collect()} == {
        10383: True,
        9999: None,
        11000: None,
        12000: None,
    }
    assert {(r.json_key, r.language, r.score) for r in parts["tech"].collect()} == {
        (10383, "Java", 3),
        (10383, "C#", 2),
        (9999, "Python", 5),
    }
    assert parts["weaknesses"].where("json_key = 12000").count() == 2


def test_reports(spark, raw):
    records, rejects = read_assessment_reports(spark, raw)
    got = {(r.first_name, r.last_name, r.psychometrics, r.presentation, r.date, r.academy) for r in records.collect()}
    first, second = dt.date(2019, 5, 1), dt.date(2019, 9, 12)
    assert got == {
        ("ADA", "O'TEST", 51, 19, first, "Northtown"),
        ("MARY-ANN", "SMITH-JONES", 100, 7, first, "Northtown"),
        ("CHER", "", 40, 8, first, "Northtown"),
        ("ADA", "O'TEST", 60, 20, second, "Southport"),
        ("LAST", "PERSON", 1, 2, second, "Southport"),
    }
    assert {(r.line, r.reject_reason) for r in rejects.collect()} == {
        ("NO DASH HERE", "no dash"),
        ("NO SCORE - Psychometrics: none", "no score"),
    }


def test_report_split_over_many_blocks(spark, tmp_path):
    """Heads and people stay together when one file is read in many splits."""
    folder = tmp_path / "Talent"
    folder.mkdir()
    people = "".join(f"PERSON {i} -  Psychometrics: {i % 101}/100, Presentation: 1/32\n" for i in range(3000))
    (folder / "big.txt").write_text("Wednesday 1 May 2019\nNorthtown Academy\n\n" + people)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records, rejects = read_assessment_reports(spark, str(tmp_path))
        assert records.select("src_block").distinct().count() > 3
        ordered = records.orderBy("src_file", "src_block", "src_row").collect()
        assert [r.last_name for r in ordered] == [str(i) for i in range(3000)]
        assert {(r.date, r.academy) for r in ordered} == {(dt.date(2019, 5, 1), "Northtown")}
        assert rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_academy_binds_columns_by_name(spark, raw):
    rows = {r.behaviour_id: r for r in read_academy(spark, raw)[0].collect()}
    assert len(rows) == 5
    business = rows["Ada_O'Test2019-07-01"]
    assert (business.trainer, business.imaginative_w1, business.analytic_w1) == ("Tom Trainer", 6.0, 1.0)
    assert rows["Ada_O'Test2019-06-03"].trainer == "Elly Kelly"


def test_academy_file_without_heading_is_rejected(spark, tmp_path):
    (tmp_path / "Academy").mkdir()
    (tmp_path / "Academy" / "Data_1_2019-01-01.csv").write_text("1,2,3\n4,5,6\n")
    (tmp_path / "Academy" / "Data_2_2019-01-01.csv").write_text('"Name", trainer ,"Analytic_W1"\n"Smith, A",T,5\nname,trainer,x\n')
    rows, rejects = scan_academy(spark, str(tmp_path))
    assert [(r.name, r.trainer, r.analytic_w1) for r in rows.orderBy("src_row").collect()] == [("Smith, A", "T", 5.0), ("name", "trainer", None)]
    assert {(r.record, r.reason) for r in rejects.collect()} == {
        ("1,2,3", "no heading with the needed columns"),
        ("4,5,6", "no heading with the needed columns"),
    }


def test_csv_loses_nothing(spark, tmp_path):
    """Other column order, quoted line breaks, quotes as letters, short, long and torn rows."""
    (tmp_path / "Talent").mkdir()
    (tmp_path / "Talent" / "a.csv").write_bytes(
        b'\xef\xbb\xbfid,name,email,gender,extra\r\n1,"A\nA, ""x""",a@x.y,F,1\r\n\r\n2,B 5"x,,NA,\r\n3,C,c\r\n4,D,d,M,e,f\r\n'
        b'5,E,"two\r\nlines\n",M,\r\nx,F,f,M,\r\n6,G,"open,M,'
    )
    (tmp_path / "Talent" / "b.csv").write_text("name,id\nH,7\n")
    rows, rejects = scan_applicants(spark, str(tmp_path))
    assert {(r.id, r.name, r.email, r.gender, r.dob) for r in rows.collect()} == {
        (1, 'A\nA, "x"', "a@x.y", "F", None),
        (2, 'B 5"x', None, None, None),
        (5, "E", "two\r\nlines\n", "M", None),
        (7, "H", None, None, None),
    }
    assert {(r.record, r.reason) for r in rejects.collect()} == {
        ("3,C,c", "too few values"),
        ("4,D,d,M,e,f", "too many values"),
        ("x,F,f,M,", "no whole number as id"),
        ('6,G,"open,M,', "quotes do not match"),
    }


def test_rejects_of_the_load(spark, tmp_path):
    root = write_raw(tmp_path / "files")
    (tmp_path / "files" / "Talent" / "abc.json").write_text('{"name": "No Key", "strengths": ["Kind"], "tech_self_score": {"Java": "3.0"}}')
    (tmp_path / "files" / "Talent" / "88.json").write_text('{"name": "Half", "date": "01/05/2019", "tech_self_score": {"Java": 3.5, "C": "x", "Go": 4}}')
    tables, rejects = build_star(spark, root)
    assert {(r.source, os.path.basename(r.src_file), r.reason) for r in rejects.collect()} == {
        ("talent", "77.json", "unreadable"),
        ("talent", "abc.json", "no whole number in the file name"),
        ("reports", "Day 1.txt", "no dash"),
        ("reports", "Day 1.txt", "no score"),
    }
    # 3.5 is cut as the surveyed load does with its integers; a word is no score
    scores = tables["tech_junction"].join(tables["tech_self_scores"], "tech_id").where("json_key = 88")
    assert {(r.tech_name, r.score) for r in scores.collect()} == {("Java", 3), ("Go", 4)}


def test_no_academy_files(spark, tmp_path):
    (tmp_path / "Academy").mkdir()
    assert read_academy(spark, str(tmp_path))[0].count() == 0


def test_talent_keeps_both_sides(spark, raw):
    records, _ = read_talent_json(spark, raw)
    reports, _ = read_assessment_reports(spark, raw)
    talent, academies = talent_tables(records, reports)
    assert {(r.json_key, r.applicant_id, r.psychometric_result) for r in talent.collect()} == {
        (10383, "adaotest20190501", 51),
        (9999, "adaotest20190501", 51),
        (12000, "maryannsmithjones20190501", 100),
        (11000, None, None),
        (None, "cher20190501", 40),
        (None, "adaotest20190912", 60),
        (None, "lastperson20190912", 1),
    }
    assert {(r.academy_location_id, r.location_name) for r in academies.collect()} == {
        (0, None),
        (1, "Northtown"),
        (2, "Southport"),
    }
    merged, same = merged_talent(records, reports)
    assert {tuple(r) for r in same.collect()} == {tuple(r) for r in academies.collect()}
    ada = merged.where("applicant_id = 'adaotest20190501'").first()
    assert (ada.json_key, ada.name, ada.self_development, ada.geo_flex) == (10383, "Ada O'Test", True, False)


def test_extracts_by_name(spark, raw):
    records, _ = read_talent_json(spark, raw)
    reports, _ = read_assessment_reports(spark, raw)
    results, academies = interview_results(records, reports)
    assert {(r.json_key, r.assessment_id, r.academyid) for r in results.collect()} == {
        (10383, "adaotest20190501", 0),
        (10383, "adaotest20190912", 1),
        (9999, "adaotest20190501", 0),
        (9999, "adaotest20190912", 1),
        (12000, "maryannsmithjones20190501", 0),
    }
    assert {tuple(r) for r in academies.collect()} == {("Northtown", 0), ("Southport", 1)}
    scores, languages = tech_by_assessment(records, reports)
    assert [r.language for r in languages.orderBy("language_id").collect()] == ["Java", "C#", "Python"]
    assert scores.count() == 6


def test_star_tables(star):
    assert {name: star[name].columns for name in COLUMNS} == COLUMNS
    assert set(star) == {*COLUMNS, *LEDGER}
    talent = {r.applicant_id: r for r in star["talent"].collect()}
    # the record of May belongs to the invitation of April; reports without interview get keys
    assert talent["adaotest20190410"].json_key == 10383
    assert talent["adaotest20190912"].json_key == 1_000_000_000
    assert [r.talent_id for r in star["talent"].orderBy("talent_id").collect()] == [1, 2, 3, 4, 5]
    linked = {(r.course_id, r.json_key) for r in star["trainees"].where("json_key IS NOT NULL").collect()}
    assert linked == {("DAT", 10383), ("DAT", 12000)}
    assert unlinked_trainees(star).count() == 3
    assert star["behaviours"].count() == 5
    assert star["behaviours"].where("imaginative IS NULL").count() == 1
    assert {r.json_key for r in star["strengths_junction"].collect()} == {10383, 12000}


def test_audits_report_only_known_gaps(star):
    found = {(r.table_name, r.rule, r.column_name): r.violations for r in audit_star(star).where("violations > 0").collect()}
    assert found == {("talent", "fk", "applicant_id"): 4, ("trainers", "not_null", "trainer"): 1}


def test_write_and_refresh(spark, star, tmp_path):
    target = str(tmp_path / "store")
    first = write_star(star, target)
    second = write_star(star, target)
    assert first != second
    assert read_star(spark, target)["talent"].count() == 5
    before = {n: sorted(map(repr, star[n].collect())) for n in COLUMNS}
    violations = {tuple(r) for r in audit_star(star).collect()}
    for _ in range(2):
        write_star(star, target, mode="append")
        stored = read_star(spark, target)
        assert {n: sorted(map(repr, stored[n].select(COLUMNS[n]).collect())) for n in COLUMNS} == before
    assert {tuple(r) for r in audit_star(stored).collect()} == violations
    assert spark.read.parquet(f"{first}/talent").count() == 5
    with pytest.raises(ValueError):
        write_star(star, target, mode="other")
    quoted = spark.createDataFrame([(1, ' say "hi", you ')], "a int, b string")
    export_csv(quoted, str(tmp_path / "quoted"))
    assert read_csv(spark, str(tmp_path / "quoted"), "a int, b string").first().b == ' say "hi", you '
    export_tables(star, str(tmp_path / "csv"), ["strengths", "tech_junction"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv" / "strengths")).columns == ["strength_id", "strength"]


def test_append_continues_ids(spark, star, tmp_path):
    """A load of other people: their recruiters, strengths and records get the next ids, references follow."""
    target = str(tmp_path / "store")
    write_star(star, target)
    longer = {n: df for n, df in star.items()}
    longer["recruiters"] = spark.createDataFrame([(1, "New Rec"), (2, "Rec One")], star["recruiters"].schema)
    person = star["applicants"].limit(1).withColumn("applicant_id", F.lit("newperson20200101"))
    longer["applicants"] = person.withColumn("recruiter_id", F.lit(1).cast("long"))
    record = star["talent"].where("json_key = 10383").withColumns(
        {"applicant_id": F.lit("newperson20200101"), "json_key": F.lit(555).cast("long"), "talent_id": F.lit(1).cast("long")}
    )
    lost = record.withColumns({"applicant_id": F.lit("lost"), "json_key": F.lit(1_000_000_000).cast("long"), "talent_id": F.lit(2).cast("long")})
    longer["talent"] = record.unionByName(lost)
    known = star["known_records"].where("json_key = 10383")
    longer["known_records"] = known.withColumns({"applicant_id": F.lit("newperson20200101"), "json_key": F.lit(555).cast("long")}).unionByName(
        known.withColumns({"applicant_id": F.lit("lost"), "json_key": F.lit(None).cast("long")})
    )
    longer["strengths"] = spark.createDataFrame([(0, "Brave"), (1, "Kind")], star["strengths"].schema)
    longer["strengths_junction"] = spark.createDataFrame([(555, 0), (555, 1)], star["strengths_junction"].schema)
    write_star(longer, target, mode="append")
    stored = read_star(spark, target)
    names = {r.recruiter_id: r.recruiter_name for r in stored["recruiters"].collect()}
    assert len(names) == star["recruiters"].count() + 1
    new = stored["applicants"].where("applicant_id = 'newperson20200101'").first()
    assert names[new.recruiter_id] == "New Rec"
    talent = {r.applicant_id: r for r in stored["talent"].collect()}
    assert sorted(r.talent_id for r in talent.values()) == list(range(1, star["talent"].count() + 3))
    assert talent["lost"].json_key == 1 + max(r.json_key for r in star["talent"].collect())
    kept = stored["strengths_junction"].join(stored["strengths"], "strength_id").where("json_key = 555").collect()
    assert {r.strength for r in kept} == {"Brave", "Kind"}
    before, after = ({(r.table_name, r.rule): r.violations for r in audit_star(t).collect() if "pk" in r.rule or r.rule == "unique"} for t in (star, stored))
    assert before == after


def test_candidates(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "20190101", "u1", "2019-01-01")], ["id", "invited_date", "iddate", "uniqueid", "Invited on"])
    append_candidates(df, str(tmp_path / "c"))
    append_candidates(df, str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    assert stored.count() == 2 and set(stored.columns) == {"id", "invited_date"}


def _age(path, seconds):
    then = time.time() - seconds
    os.utime(path, (then, then))


def test_since_continues_ids(spark, tmp_path):
    root = write_raw(tmp_path / "files")
    _age(f"{root}/Talent/April2019.csv", 7200)
    cutoff = dt.datetime.fromtimestamp(time.time() - 3600, dt.timezone.utc)
    assert [os.path.basename(r.path) for r in list_files(spark, f"{root}/Talent", ".csv", cutoff).collect()] == ["Sept2019.csv"]
    everything = applicant_tables(read_applicants(spark, root)[0])
    old = applicant_tables(
        read_applicants(spark, root)[0].where(F.col("src_file").contains("April")),
    )
    current = {name: stage(old[name], name) for name in ("recruiters", "location")}
    new = applicants_since(spark, root, cutoff, current)
    assert {(r.recruiter_id, r.recruiter_name) for r in new["recruiters"].collect()} == {(4, "Bruno Bellbrook")}
    assert {(r.applicant_id, r.recruiter_id) for r in new["applicants"].collect()} == {
        ("eveearly00000000", 2),
        ("adaotest20190905", 4),
    }
    assert {r.location_id for r in new["location"].collect()} == {4, 5}
    assert everything["location"].count() == 6
    nothing = applicants_since(spark, root, dt.datetime.fromtimestamp(time.time() + 3600, dt.timezone.utc), current)
    assert {name: df.count() for name, df in nothing.items()} == {"applicants": 0, "location": 0, "recruiters": 0, "rejects": 0}


def test_since_is_strict_and_utc(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\n")
    moment = 1_600_000_000
    os.utime(tmp_path / "a.txt", (moment, moment))
    at = dt.datetime.fromtimestamp(moment, dt.timezone.utc)
    count = lambda t: file_reader(spark, ".txt", t).text(str(tmp_path)).count()
    assert (count(at), count(at - dt.timedelta(seconds=1))) == (0, 1)


def test_streamed_updates(spark, tmp_path):
    root = write_raw(tmp_path / "files")
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "ckpt")
    late = tmp_path / "files" / "Talent" / "Sept2019.csv"
    text = late.read_text()
    late.unlink()
    run_applicant_updates(spark, root, target, checkpoint)
    late.write_text(text)
    run_applicant_updates(spark, root, target, checkpoint)
    names = {r.recruiter_id: (r.recruiter_name, r.batch_id) for r in spark.read.parquet(f"{target}/recruiters").collect()}
    assert names == {1: ("Rec One", 0), 2: ("Fifi Eton", 0), 3: (None, 0), 4: ("Bruno Bellbrook", 1)}
    assert spark.read.parquet(f"{target}/applicants").count() == 6
