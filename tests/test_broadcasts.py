"""The driver holds what is broadcast, several times at once, so only what is small there is; the rows do not depend on it."""

from pyspark.sql import functions as F

from rosterflow.operators import joins as J
from rosterflow.operators.linking import apply_links
from rosterflow.plans import appending
from rosterflow.session import stage_packed

#: beyond the bound as the driver would hold them, though some 3 MB as values and 1 MB as files
MANY = 400_000


def sides(spark):
    left = stage_packed(spark.range(0, 2 * MANY, 1000).withColumnRenamed("id", "k"), "few")
    return left, stage_packed(spark.range(MANY).withColumnRenamed("id", "k"), "many")


def broadcasts(df):
    """Whether one of the joins of ``df`` is planned with a broadcast."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" in plan
    return "Broadcast" in plan


def test_rows_count_with_what_the_driver_holds_of_them(spark):
    few, many = sides(spark)
    assert J.fits_broadcast(few) and not J.fits_broadcast(many)


def test_keys_of_many_records_are_shuffled(spark):
    few, many = sides(spark)
    kept = J.keep_members(few, many, "k")
    assert not broadcasts(kept) and kept.count() == MANY // 1000
    assert broadcasts(J.keep_members(many, few, "k"))


def test_files_that_are_packed_are_measured(spark):
    few, many = sides(spark)
    for how, n in (("left", 2 * MANY // 1000), ("left_semi", MANY // 1000), ("left_anti", MANY // 1000)):
        # Spark's own choice is to broadcast
        assert broadcasts(J.equi_join(few, many, ["k"], how, False))
        for null_safe in (False, True):
            found = appending.lookup(few, many, ["k"], how, null_safe)
            assert not broadcasts(found) and found.count() == n
        assert broadcasts(appending.lookup(many, few, ["k"], how))
    # of an inner join either side may be broadcast
    wide = many.select("k", F.lit(None).cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    for pair in ((many, wide), (wide, many)):
        assert broadcasts(J.equi_join(*pair, ["k"], "inner", False))
        found = appending.lookup(*pair, ["k"], "inner")
        assert not broadcasts(found) and found.count() == MANY
    for pair in ((many, few), (few, many)):
        found = appending.lookup(*pair, ["k"], "inner")
        assert broadcasts(found) and found.count() == MANY // 1000


def test_a_bound_of_spark_that_is_off_stays_off(spark):
    few, many = sides(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = appending.lookup(many, few, ["k"], "inner")
        assert not broadcasts(found) and found.count() == MANY // 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_parents_and_links_of_many_records_are_shuffled(spark):
    few, many = sides(spark)
    facts = few.select("k", F.lit(1).alias("mark"))
    found = J.surrogate_join(facts, many.withColumn("parent", F.col("k") + 1), "k", "parent")
    assert not broadcasts(found) and found.columns == ["mark", "parent"] and found.count() == MANY // 1000
    links = many.withColumn("to", F.col("k") * 2)
    linked = apply_links(few, links, "k", "to", "at")
    assert not broadcasts(linked) and linked.where("at IS NOT NULL").count() == MANY // 1000 and linked.count() == 2 * MANY // 1000
