"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: of the tables of a star and of what its load stages: a third less room than Spark's default
COMPRESSION = "zstd"

#: tasks that run at the same time
MOST_TOGETHER = 3

#: folders of the runs that are going on, the innermost last
_RUNS: list[str] = []


def build_session(app: str = "rosterflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; cluster settings win when already given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="rosterflow-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder below the shared one that takes all tables staged inside the block and is removed at its end.

    Results are to be written by then. Without it staged tables stay, so that lazy results remain readable.
    """
    folder = f"{checkpoint_root(spark)}/run-{uuid.uuid4().hex}"
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder, or that of the run, and read it back.

    Cuts the lineage, fixes row positions and ids against task retries, and keeps column
    pruning and filter pushdown for the readers (a checkpoint would store whole rows).
    """
    spark = df.sparkSession
    path = f"{_RUNS[-1] if _RUNS else checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def stage_packed(df: DataFrame, label: str) -> DataFrame:
    """As ``stage``, in less room."""
    return stage(df, label, COMPRESSION)


def together(spark: SparkSession, *tasks: Callable) -> list:
    """Results of independent tasks, of which ``MOST_TOGETHER`` may run their Spark jobs at the same time.

    Keeps executors busy while one job waits for its last tasks. More at once would not, but the driver holds the plans,
    threads and broadcasts of all that run. Job groups are inherited.
    """
    with ThreadPoolExecutor(min(len(tasks), MOST_TOGETHER)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
        return [f.result() for f in futures]


def release(spark: SparkSession) -> None:
    """Let the driver drop what finished jobs left behind, and give memory back.

    Spark removes their shuffle files and broadcasts only when the driver's garbage is collected, which it puts off for as
    long as the heap can grow.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
