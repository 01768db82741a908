"""A later load adds weeks and junction rows of stored people; contradicting marks are rejected."""

from pyspark.sql import functions as F
from test_raw_files import raw, star  # noqa: F401

from rosterflow.sinks.tables import read_star, write_star


def test_append_extends_stored_records(spark, star, tmp_path):  # noqa: F811
    target = str(tmp_path / "store")
    week = star["behaviours"].agg(F.min("week_number")).first()[0]
    part = {"behaviours": f"week_number = {week}", "tech_junction": "tech_id % 2 = 0", "strengths_junction": "strength_id % 2 = 0", "weaknesses_junction": "weakness_id % 2 = 0"}
    write_star({n: df.where(part.get(n, "true")) for n, df in star.items()}, target)
    stored = read_star(spark, target)
    assert any(stored[n].count() < star[n].count() for n in part)
    changed = star["tech_junction"].withColumn("score", F.when(F.col("tech_id") % 2 == 0, F.col("score") + 1).otherwise(F.col("score")))
    folder = write_star({**star, "tech_junction": changed}, target, mode="append")
    stored = read_star(spark, target)
    for name in part:
        columns = [c for c in star[name].columns if c != "behaviour_id"]
        assert sorted(map(repr, stored[name].select(columns).collect())) == sorted(map(repr, star[name].select(columns).collect())), name
    ids = [r.behaviour_id for r in stored["behaviours"].collect()]
    assert len(set(ids)) == len(ids)
    rejects = spark.read.parquet(f"{folder}/append_rejects").collect()
    assert {r.source for r in rejects} == {"tech_junction"}
    assert len(rejects) == star["tech_junction"].where("tech_id % 2 = 0").count()
