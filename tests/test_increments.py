"""A star loaded in parts is the star of one load; contradictions are rejected, ids stay."""

import pytest
from pyspark.sql import functions as F
from raw_files import write_raw

from rosterflow.checks.queries import _by_names
from rosterflow.plans.appending import REJECTS, continue_star
from rosterflow.plans.star import COLUMNS, audit_star, build_star
from rosterflow.session import stage
from rosterflow.sinks.tables import read_ledger, read_star, write_star


def contents(tables):
    return {n: sorted(map(repr, df.collect())) for n, df in _by_names(tables).items()}


def stored(spark, target):
    return read_star(spark, target) | read_ledger(spark, target)


def part(tmp_path, name, keep):
    """A copy of the raw files that ``keep`` names."""
    root = tmp_path / name
    write_raw(root)
    for folder in ("Talent", "Academy"):
        for path in sorted((root / folder).iterdir()):
            if not keep(f"{folder}/{path.name}"):
                path.unlink()
    return str(root)


@pytest.mark.parametrize("first", [
    lambda n: n.endswith(".json"),
    lambda n: n.startswith("Academy") or n.endswith(".txt") or "Sept" in n,
], ids=["interviews", "all but interviews and some applicants"])
def test_two_loads_make_the_star_of_one(spark, tmp_path, first):
    whole = build_star(spark, part(tmp_path, "whole", lambda n: True))[0]
    target = str(tmp_path / "store")
    loads = [build_star(spark, part(tmp_path, name, keep))[0] for name, keep in (("a", first), ("b", lambda n: not first(n)))]
    write_star(loads[0], target)
    early = {n: df.collect() for n, df in read_star(spark, target).items()}
    write_star(loads[1], target, mode="append")
    both = stored(spark, target)
    expected = contents(whole)
    found = contents(both)
    for name in expected:
        # no academy is a row as soon as one load knows a record without it
        drop = (lambda rows: [r for r in rows if "None" not in r]) if name == "academy_locations" else (lambda rows: rows)
        assert drop(found[name]) == drop(expected[name]), name
    # what was stored keeps its id
    for name, key in (("recruiters", "recruiter_id"), ("strengths", "strength_id"), ("trainers", "trainer_id"), ("location", "location_id")):
        values = [c for c in COLUMNS[name] if c != key]
        before = {tuple(r[c] for c in values): r[key] for r in early[name]}
        after = {tuple(r[c] for c in values): r[key] for r in both[name].collect()}
        assert before.items() <= after.items() and len(set(after.values())) == len(after)
    keys = {(r["table_name"], r["rule"], r["column_name"]): r["violations"] for r in audit_star(both).collect()}
    one = {(r["table_name"], r["rule"], r["column_name"]): r["violations"] for r in audit_star(whole).collect()}
    assert keys == one
    write_star(loads[0], target, mode="append")
    assert contents(stored(spark, target)) == found


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    root = write_raw(tmp_path_factory.mktemp("star"))
    return {n: stage(df, n) for n, df in build_star(spark, root)[0].items()}


def test_other_people_of_one_course_stay_apart(spark, star):
    """Two loads with different trainees, none of them linked, of one trainer and course."""
    roster = star["known_roster"].withColumn("name", F.concat(F.lit("Other "), "name"))
    new = star | {"known_roster": roster, "trainees": star["trainees"].withColumn("json_key", F.lit(None).cast("long"))}
    both = continue_star(star, new)
    assert both["trainees"].count() == 2 * star["trainees"].count()
    assert both["behaviours"].count() == 2 * star["behaviours"].count()
    names = both["known_roster"].join(both["behaviours"], "trainee_id").groupBy("name").count().collect()
    alone = star["known_roster"].join(star["behaviours"], "trainee_id").groupBy("name").count().collect()
    expected = {r["name"]: r["count"] for r in alone} | {f"Other {r['name']}": r["count"] for r in alone}
    assert {r["name"]: r["count"] for r in names} == expected
    assert both[REJECTS].collect() == []


def test_contradictions_are_rejected(spark, star):
    changes = {
        "applicants": ("email", "'other@example.com'"),
        "courses": ("course_name", "'Another'"),
        "behaviours": ("analytic", "-1"),
        "tech_junction": ("score", "-1"),
        "known_records": ("result", "CASE WHEN result IS NOT NULL THEN 7 END"),
        "known_roster": ("trainer_id", "CASE trainer_id WHEN '1' THEN '2' ELSE '1' END"),
    }
    new = dict(star)
    for table, (column, value) in changes.items():
        new[table] = star[table].withColumn(column, F.expr(value).cast(dict(star[table].dtypes)[column]))
    both = continue_star(star, new)
    rejects = both[REJECTS].groupBy("source", "reason").count().collect()
    expected = {t: star[t].count() for t in changes}
    expected["talent"] = star["known_records"].where("result IS NOT NULL").count()
    expected["trainees"] = expected.pop("known_roster")
    del expected["known_records"]
    assert {r["source"]: r["count"] for r in rejects} == expected and all(expected.values())
    assert {r["reason"] for r in rejects} == {"contradicts a stored row"}
    assert {n: sorted(map(repr, both[n].collect())) for n in COLUMNS} == {n: sorted(map(repr, star[n].collect())) for n in COLUMNS}


def test_needs_a_ledger(star):
    with pytest.raises(ValueError):
        continue_star({n: star[n] for n in COLUMNS}, star)
