"""All four kinds of files as they arrive, and the star that grows with them.

Each source has a checkpointed file stream. Its batches are cleaned and written to a landing folder under the source and
the batch's number, so a batch that runs again writes over itself. What has landed and is in no version of the star yet
is then added as one load. The numbers of the batches that a version holds are a table of that version, so they become
visible together with its rows: a run that fails between the steps is taken up again, and nothing is added twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.plans.star import assemble_star, load_rejects
from rosterflow.session import stage
from rosterflow.sinks.tables import exists, read_landed, write_star
from rosterflow.sources.academy import academy_rows, clean_academy
from rosterflow.sources.applicants import applicant_rows, clean_applicants
from rosterflow.sources.files import with_row_count, with_split
from rosterflow.sources.reports import parse_reports
from rosterflow.sources.reports import split_rejects as report_parts
from rosterflow.sources.schemas import TALENT_JSON
from rosterflow.sources.talent import clean_talent
from rosterflow.sources.talent import split_rejects as talent_parts
from rosterflow.functions import report as R

Parts = tuple[DataFrame, DataFrame]


def _applicants(batch: DataFrame) -> Parts:
    rows, rejects = applicant_rows(stage(with_row_count(batch), "csv-lines-batch"))
    return clean_applicants(rows), rejects


def _academy(batch: DataFrame) -> Parts:
    rows, rejects = academy_rows(stage(with_row_count(batch), "csv-lines-batch"))
    return clean_academy(rows), rejects


def _reports(batch: DataFrame) -> Parts:
    lines = with_row_count(batch).withColumn("value", R.drop_returns(F.col("value")))
    return report_parts(stage(parse_reports(lines), "reports-batch"))


def _talent(batch: DataFrame) -> Parts:
    return talent_parts(stage(clean_talent(batch), "talent-batch"))


#: source: folder, ending of its files, cleaning of a batch
SOURCES: dict[str, tuple[str, str, Callable[[DataFrame], Parts]]] = {
    "applicants": ("Talent", ".csv", _applicants),
    "interviews": ("Talent", ".json", _talent),
    "reports": ("Talent", ".txt", _reports),
    "academy": ("Academy", ".csv", _academy),
}


def _files(spark: SparkSession, raw_dir: str, source: str, most_files: int | None) -> DataFrame:
    folder, ending, _ = SOURCES[source]
    reader = spark.readStream.option("pathGlobFilter", f"*{ending}").option("recursiveFileLookup", True)
    if most_files:
        reader = reader.option("maxFilesPerTrigger", most_files)
    if ending == ".json":
        reader = reader.schema(TALENT_JSON).option("multiLine", True).option("mode", "PERMISSIVE")
        objects = reader.option("columnNameOfCorruptRecord", "_corrupt").json(f"{raw_dir}/{folder}")
        return with_split(objects).drop("src_block")
    return with_split(reader.option("lineSep", "\n").option("encoding", "UTF-8").text(f"{raw_dir}/{folder}"))


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """A batch's files are listed by some tasks per core; by default each file is a task of its own, up to 10,000."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    given = spark.conf.get(key, None)
    if given is None:
        spark.conf.set(key, 4 * spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(key)


def land(spark: SparkSession, raw_dir: str, landing: str, source: str, most_files: int | None = None) -> None:
    """Clean all files of a source that were not seen before, in batches of ``most_files``, into the landing folder."""
    clean = SOURCES[source][2]

    def store(batch: DataFrame, number: int) -> None:
        for part, df in zip(("rows", "rejects"), clean(batch)):
            df.write.mode("overwrite").parquet(f"{landing}/{source}/{part}/batch={number}")

    stream = _files(spark, raw_dir, source, most_files).writeStream.foreachBatch(store)
    stream = stream.option("checkpointLocation", f"{landing}/{source}/checkpoint").trigger(availableNow=True)
    with _few_listing_tasks(spark):
        stream.start().awaitTermination()


def landed(spark: SparkSession, landing: str, source: str, part: str = "rows") -> DataFrame | None:
    """What has landed of a source, with its ``batch``; None before the first file. Columns may differ from batch to batch."""
    folder = f"{landing}/{source}/{part}"
    if not exists(spark, folder):
        return None
    return spark.read.option("mergeSchema", True).parquet(folder)


def run_updates(spark: SparkSession, raw_dir: str, target: str, landing: str, most_files: int | None = None) -> str | None:
    """Land the new files of all sources and add them to the star in ``target``; the folder of the new version, or None
    if there is nothing to add."""
    for source in SOURCES:
        land(spark, raw_dir, landing, source, most_files)
    return add_landed(spark, target, landing)


def add_landed(spark: SparkSession, target: str, landing: str) -> str | None:
    """Add the batches that no version of the star holds yet, as one load."""
    held = read_landed(spark, target)
    rows, rejects, batches = {}, {}, []
    for source in SOURCES:
        for part, found in (("rows", rows), ("rejects", rejects)):
            df = landed(spark, landing, source, part)
            if df is None:
                continue
            done = {r["batch"] for r in held.where(F.col("source") == source).collect()}
            found[source] = stage(df.where(~F.col("batch").isin(*done)) if done else df, f"landed-{source}")
        if source in rejects:
            known = {int(n) for n in _batches(spark, f"{landing}/{source}/rejects")}
            batches += [(source, n) for n in sorted(known - done)]
    if not batches:
        return None
    shapes = _shapes(spark)
    parts = {s: rows[s].drop("batch") if s in rows else shapes[s] for s in SOURCES}
    tables = assemble_star(parts["applicants"], parts["interviews"], parts["reports"], parts["academy"], keep=True)
    spoken = {s: rejects[s].drop("batch") if s in rejects else shapes[f"{s} rejects"] for s in SOURCES}
    refused = load_rejects(spoken["interviews"], spoken["reports"], spoken["applicants"], spoken["academy"])
    now = held.unionByName(spark.createDataFrame(batches, held.schema))
    mode = "append" if exists(spark, f"{target}/_versions") else "refresh"
    return write_star(tables, target, mode, landed=now, load_rejects=refused)


def _batches(spark: SparkSession, folder: str) -> list[str]:
    """Numbers of the batches in a folder; one name per batch."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
    return [n.removeprefix("batch=") for n in names if n.startswith("batch=")]


def _shapes(spark: SparkSession) -> dict[str, DataFrame]:
    """Empty rows and rejects of every source."""
    lines = spark.createDataFrame([], "value string, src_file string, src_block long, src_row long")
    objects = spark.createDataFrame([], TALENT_JSON).withColumn("src_file", F.lit(""))
    shapes = {}
    for source, (_, ending, clean) in SOURCES.items():
        shapes[source], shapes[f"{source} rejects"] = clean(objects if ending == ".json" else lines.drop("src_row"))
    return shapes
