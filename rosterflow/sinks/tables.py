"""Writing the tables: exports, appends and full refresh."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.plans.appending import LEDGER, star_parts
from rosterflow.session import COMPRESSION, release, together

#: table in a version that names the folders of tables which are not, or not only, its own
_PARTS = "_parts"
#: a table in more folders than these is written whole again
MOST_PARTS = 32
_LOG = "_versions"
_HOLDS = "_holds"


def export_csv(df: DataFrame, folder: str) -> None:
    """One CSV folder; values keep their blanks, quotes inside values are doubled."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def export_json(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").json(folder)


def export_tables(tables: dict[str, DataFrame], folder: str, names: list[str]) -> None:
    """CSV export of dimensions and junctions, one folder each."""
    for name in names:
        export_csv(tables[name], f"{folder}/{name}")


def append_candidates(df: DataFrame, target: str) -> None:
    """Applicant-only load: raw ids and dates dropped, the cleaned ones take their names."""
    rows = df.drop("id", "iddate", "invited_date").withColumnsRenamed(
        {"uniqueid": "id", "Invited on": "invited_date"}
    )
    rows.write.mode("append").parquet(target)


def write_star(tables: dict[str, DataFrame], target: str, mode: str = "refresh", **more: DataFrame) -> str:
    """Write all tables as a new version and then log it; return the folder written to.

    Readers see the old version until all tables are complete, and no path is overwritten while it is read. "refresh"
    stores the tables as they are; "append" adds to the current version what it lacks, links people again where the load
    matters to them, and writes what contradicts it to a further table of the version, ``append_rejects`` (see
    ``continue_star``). It needs tables that ``build_star`` made, on both sides, since these come with a ledger.
    ``more`` are further tables of the version.
    """
    if mode not in ("refresh", "append"):
        raise ValueError("mode must be refresh or append")
    spark = next(iter(tables.values())).sparkSession
    if mode == "refresh":
        written = _write_version(spark, target, {name: [df] for name, df in {**tables, **more}.items()}, {}, {})
    else:
        # what the new version does not write again has to stay until it is logged
        with hold_version(spark, target) as folder:
            stored = _read(spark, target, folder, _star_names()) | _read_known(spark, target, folder)
            parts = star_parts(stored, tables) | {name: [df] for name, df in more.items()}
            written = _write_version(spark, target, parts, stored, _folders(spark, folder))
    release(spark)
    return written


def _write_version(
    spark: SparkSession, target: str, tables: dict[str, list[DataFrame]], stored: dict[str, DataFrame], held: dict[str, list[str]]
) -> str:
    """Write and log a version. A part that is a table of ``stored`` stays in its folders, those of ``held`` or that of
    the stored version, and is named in the new version."""
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{target}/{version}"
    named, writes = [], []
    for name, parts in tables.items():
        places = held.get(name, []) if name in stored and parts[0] is stored[name] else []
        if places and len(places) < MOST_PARTS:
            named += [(name, place) for place in places]
            parts = parts[1:]
            if parts:
                named.append((name, f"{version}/{name}"))
        if parts:
            writes.append(partial(_write, reduce(DataFrame.unionByName, parts), f"{folder}/{name}"))
    if named:
        rows = spark.createDataFrame(named, "name string, folder string").coalesce(1)
        writes.append(partial(_write, rows, f"{folder}/{_PARTS}"))
    together(spark, *writes)
    log = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("written_at"))
    log.coalesce(1).write.mode("append").parquet(f"{target}/{_LOG}")
    return folder


def _write(df: DataFrame, folder: str) -> None:
    df.write.option("compression", COMPRESSION).parquet(folder)


def current_version(spark: SparkSession, target: str) -> str:
    log = spark.read.schema("version string, written_at timestamp").parquet(f"{target}/{_LOG}")
    return f"{target}/{log.agg(F.max_by('version', 'written_at')).first()[0]}"


def _folders(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """The folders, below the target, of every table of a version."""
    version = folder.rsplit("/", 1)[1]
    files, path = _located(spark, folder)
    names = [f.getPath().getName() for f in files.listStatus(path)]
    found = {name: [f"{version}/{name}"] for name in names if name != _PARTS}
    if _PARTS in names:
        named: dict[str, list[str]] = {}
        for row in spark.read.schema("name string, folder string").parquet(f"{folder}/{_PARTS}").collect():
            named.setdefault(row["name"], []).append(row["folder"])
        found |= named
    return found


def _star_names() -> list[str]:
    from rosterflow.plans.star import COLUMNS

    return list(COLUMNS)


def _read(spark: SparkSession, target: str, folder: str, names: list[str]) -> dict[str, DataFrame]:
    places = _folders(spark, folder)
    return {name: spark.read.parquet(*(f"{target}/{place}" for place in places[name])) for name in names}


def _read_known(spark: SparkSession, target: str, folder: str) -> dict[str, DataFrame]:
    return _read(spark, target, folder, list(LEDGER)) if LEDGER[0] in _folders(spark, folder) else {}


def read_star(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    return _read(spark, target, current_version(spark, target), _star_names())


def read_ledger(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """What the current version keeps beside its tables; empty if it was written without."""
    return _read_known(spark, target, current_version(spark, target))


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """source and batch of the file batches that the current version holds; empty if there are none."""
    schema = "source string, batch long"
    if exists(spark, f"{target}/{_LOG}"):
        folder = f"{current_version(spark, target)}/landed"
        if exists(spark, folder):
            return spark.read.schema(schema).parquet(folder)
    return spark.createDataFrame([], schema)


@contextmanager
def hold_version(spark: SparkSession, target: str) -> Iterator[str]:
    """The folder of the current version, which ``remove_versions`` leaves in place until the block ends.

    The hold is an empty file beside the versions, so it counts for jobs of other sessions too. A job that is lost leaves
    its hold behind; then the version stays until that file is deleted.
    """
    folder = current_version(spark, target)
    files, path = _located(spark, f"{target}/{_HOLDS}/{folder.rsplit('/', 1)[1]}.{uuid.uuid4().hex}")
    files.create(path, False).close()
    try:
        if not exists(spark, folder):
            raise RuntimeError("the version was removed while it was taken hold of; read again")
        yield folder
    finally:
        files.delete(path, False)


def remove_versions(spark: SparkSession, target: str, keep: int = 2) -> tuple[list[str], list[str]]:
    """Deletes all but the newest ``keep`` versions; returns the names of those deleted, and of older ones that a reader holds.

    The list of versions has one row per load. What is not in it, such as a version that is still being written, is not
    touched, and a run that was cut short is finished by the next one. Tables of a deleted version that are also tables of
    one that stays remain in its folder until no version names them.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    log = spark.read.schema("version string, written_at timestamp").parquet(f"{target}/{_LOG}")
    logged = [r["version"] for r in log.orderBy(F.desc("written_at"), F.desc("version")).collect()]
    older = [version for version in logged if exists(spark, f"{target}/{version}")][keep:]
    files, holds = _located(spark, f"{target}/{_HOLDS}")
    names = [f.getPath().getName() for f in files.listStatus(holds)] if files.exists(holds) else []
    held = {name.split(".")[0] for name in names}
    stay = [version for version in logged if exists(spark, f"{target}/{version}") and (version not in older or version in held)]
    needed = {place for version in stay for places in _folders(spark, f"{target}/{version}").values() for place in places}
    removed = [version for version in older if version not in held and _remove(spark, target, version, needed)]
    return removed, [version for version in older if version in held]


def _remove(spark: SparkSession, target: str, version: str, needed: set[str]) -> bool:
    """Delete what no other version needs of a version; whether there was anything to delete."""
    files, path = _located(spark, f"{target}/{version}")
    if not any(place.startswith(f"{version}/") for place in needed):
        return files.delete(path, True)
    entries = [f.getPath() for f in files.listStatus(path)]
    surplus = [entry for entry in entries if f"{version}/{entry.getName()}" not in needed]
    for entry in surplus:
        files.delete(entry, True)
    return bool(surplus)


def _located(spark: SparkSession, folder: str) -> tuple:
    """The file system of a folder, and its path there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    files, path = _located(spark, folder)
    return files.exists(path)


def append_jdbc(tables: dict[str, DataFrame], url: str, properties: dict | None = None) -> None:
    """Append all tables to a database, parents before children; date and id columns as they are."""
    for name, df in tables.items():
        if name in LEDGER:
            continue
        df.write.jdbc(url, name, mode="append", properties=properties)
