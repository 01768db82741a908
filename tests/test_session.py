import os
from types import SimpleNamespace

import pytest

from rosterflow.session import checkpoint_root, run_folder, stage, together


def fake(master, conf=None, folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf or default), sparkContext=context)


def test_cluster_folder_is_used():
    assert checkpoint_root(fake("yarn", conf="hdfs:///shared/")) == "hdfs:///shared"
    assert checkpoint_root(fake("yarn", folder="s3a://b/c")) == "s3a://b/c"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        checkpoint_root(fake("spark://host:7077"))


def test_stage_keeps_schema_and_rows(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, map('x', 2) AS m, array(1, NULL) AS l")
    staged = stage(df, "kept")
    assert staged.dtypes == df.dtypes and staged.collect() == df.collect()
    assert stage(df.where("a > 1"), "empty").count() == 0


def test_run_folder_is_removed(spark, tmp_path):
    with run_folder(spark) as folder:
        staged = stage(spark.range(5), "short")
        with run_folder(spark) as inner:
            assert stage(spark.range(2), "inner").inputFiles()[0].removeprefix("file://").startswith(inner.removeprefix("file:"))
        assert not os.path.exists(inner.removeprefix("file:"))
        assert staged.count() == 5 and os.path.exists(folder.removeprefix("file:"))
        staged.write.parquet(str(tmp_path / "kept"))
    assert not os.path.exists(folder.removeprefix("file:"))
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 5


def test_together_keeps_order_and_raises(spark):
    assert together(spark, lambda: spark.range(3).count(), lambda: "b") == [3, "b"]
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1, lambda: 1 / 0)
