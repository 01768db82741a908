import os

import pytest

from rosterflow.sinks.tables import current_version, hold_version, remove_versions, write_star


def versions(target):
    return sorted(n for n in os.listdir(target) if n.startswith("v-"))


def test_old_versions_go_unless_a_reader_holds_them(spark, tmp_path):
    target = str(tmp_path / "star")
    written = [write_star({"numbers": spark.range(n)}, target).rsplit("/", 1)[1] for n in (1, 2)]
    with hold_version(spark, target) as held:
        assert held == current_version(spark, target) and held.endswith(written[1])
        written += [write_star({"numbers": spark.range(n)}, target).rsplit("/", 1)[1] for n in (3, 4)]
        removed, refused = remove_versions(spark, target, keep=1)
        assert sorted(removed) == sorted([written[0], written[2]]) and refused == [written[1]]
        assert spark.read.parquet(f"{held}/numbers").count() == 2
    assert remove_versions(spark, target, keep=2) == ([], [])
    assert versions(target) == sorted([written[1], written[3]])
    assert remove_versions(spark, target, keep=1) == ([written[1]], [])
    assert versions(target) == [written[3]]
    assert spark.read.parquet(f"{current_version(spark, target)}/numbers").count() == 4


def test_the_current_version_stays(spark, tmp_path):
    target = str(tmp_path / "star")
    write_star({"numbers": spark.range(1)}, target)
    with pytest.raises(ValueError):
        remove_versions(spark, target, keep=0)
    assert remove_versions(spark, target) == ([], []) and len(versions(target)) == 1
