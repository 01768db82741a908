"""Streams of all four sources and the star that grows with them."""

from raw_files import write_raw
from test_increments import contents, part, stored

from rosterflow.plans.star import build_star
from rosterflow.sinks.tables import current_version, read_landed
from rosterflow.streaming.landing import SOURCES, add_landed, land, landed, run_updates


def test_star_grows_with_arriving_files(spark, tmp_path):
    root = part(tmp_path, "raw", lambda n: n.endswith(".json") or "Sept" in n)
    target, landing = str(tmp_path / "store"), str(tmp_path / "landing")
    first = run_updates(spark, root, target, landing)
    assert first == current_version(spark, target)
    write_raw(tmp_path / "more")
    for path in sorted((tmp_path / "more").rglob("*.*")):
        if not path.name.endswith(".json") and "Sept" not in path.name:
            path.rename(tmp_path / "raw" / path.relative_to(tmp_path / "more"))
    # files land, the run fails before they are added, and the next one takes them up
    for source in SOURCES:
        land(spark, root, landing, source, most_files=2)
    assert current_version(spark, target) == first
    second = run_updates(spark, root, target, landing)
    assert second != first and run_updates(spark, root, target, landing) is None
    assert add_landed(spark, target, landing) is None
    found = contents(stored(spark, target))
    tables, refused = build_star(spark, root)
    whole = contents(tables)
    for name in whole:
        assert [r for r in found[name] if name != "academy_locations" or "None" not in r] == [
            r for r in whole[name] if name != "academy_locations" or "None" not in r
        ], name
    held = {(r["source"], r["batch"]) for r in read_landed(spark, target).collect()}
    assert {s for s, _ in held} == set(SOURCES) and len(held) > len(SOURCES)
    rejects = spark.read.parquet(f"{first}/load_rejects").unionByName(spark.read.parquet(f"{second}/load_rejects"))
    key = ["source", "record", "reason"]
    assert sorted(map(repr, rejects.select(key).collect())) == sorted(map(repr, refused.select(key).collect()))


def test_nothing_arrives(spark, tmp_path):
    for folder in ("Talent", "Academy"):
        (tmp_path / "raw" / folder).mkdir(parents=True)
    landing = str(tmp_path / "landing")
    assert run_updates(spark, str(tmp_path / "raw"), str(tmp_path / "store"), landing) is None
    assert landed(spark, landing, "reports") is None


def test_objects_are_written_by_many_tasks(spark, tmp_path):
    from rosterflow.checks.queries import _write_objects

    objects = spark.createDataFrame([(i, f"n{i % 30}") for i in range(60)], "s_suppkey long, name string").coalesce(1)
    _write_objects(objects, str(tmp_path / "Talent"))
    files = [p.name for p in (tmp_path / "Talent").glob("*.json")]
    assert len(files) == 60 and len({name.split("-")[1] for name in files}) > 1
    assert sorted(r["name"] for r in spark.read.json(str(tmp_path / "Talent")).collect()) == sorted(f"n{i % 30}" for i in range(60))


def test_files_of_a_batch_are_listed_by_few_tasks(spark):
    from rosterflow.streaming.landing import _few_listing_tasks

    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    with _few_listing_tasks(spark):
        assert int(spark.conf.get(key)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, 3)
    with _few_listing_tasks(spark):
        assert int(spark.conf.get(key)) == 3
    assert int(spark.conf.get(key)) == 3
    spark.conf.unset(key)
