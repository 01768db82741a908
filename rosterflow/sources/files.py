"""File selection, generic readers and positions of rows in their files."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.paths import source_path
from rosterflow.sources.schemas import MISSING


def file_reader(spark: SparkSession, suffix: str, since: datetime | str | None = None) -> DataFrameReader:
    """Reader for all files ending in ``suffix`` below a folder, modified after ``since``.

    Suffix and time are tested while listing, so skipped files are never opened. ``since`` is
    read as UTC and compared by whole seconds here; ``modified_after`` compares the rest.
    """
    reader = (
        spark.read.option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", True)
        .option("encoding", "UTF-8")
    )
    if since is not None:
        text = since if isinstance(since, str) else since.strftime("%Y-%m-%dT%H:%M:%S.%f")
        # sub-second digits are not part of the option's format
        reader = reader.option("modifiedAfter", text.split(".")[0]).option("timeZone", "UTC")
    return reader


def csv_reader(reader: DataFrameReader, schema: str) -> DataFrameReader:
    """CSV with a heading line; a quote inside a quoted value is doubled, a backslash is a letter."""
    return reader.schema(schema).option("header", True).option("escape", '"')


def without_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Texts that stand for a missing value become null."""
    return df.withColumns({c: F.when(~F.col(c).isin(*MISSING), F.col(c)) for c in columns})


def modified_after(df: DataFrame, since: datetime | str | None) -> DataFrame:
    """Rows of files modified after ``since``, to the millisecond; the reader's own filter knows whole seconds only."""
    if since is None:
        return df
    moment = (datetime.fromisoformat(since) if isinstance(since, str) else since).replace(tzinfo=timezone.utc)
    micros = (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return df.where(F.col("_metadata.file_modification_time") > F.timestamp_micros(F.lit(micros)))


def with_file_position(df: DataFrame) -> DataFrame:
    """Add src_file, src_block, src_row; use directly on a scan.

    A file split is read in order by one task, so (file, offset of the split, row counter of the
    task) sorts rows as they stand in the file, however Spark packs the splits. The counter's
    value itself has no meaning.
    """
    return with_row_count(with_split(df))


def with_split(df: DataFrame) -> DataFrame:
    """Add src_file and src_block, on a scan or a file stream."""
    return df.select(*df.columns, source_path().alias("src_file"), F.col("_metadata.file_block_start").alias("src_block"))


def with_row_count(df: DataFrame) -> DataFrame:
    """Add src_row where rows still stand as they were read; a stream has them so in each of its batches."""
    return df.withColumn("src_row", F.monotonically_increasing_id())


POSITION = ["src_file", "src_block", "src_row"]


def list_files(spark: SparkSession, folder: str, suffix: str = "", since: datetime | str | None = None) -> DataFrame:
    """Path, modification time and length of the files; contents are not read."""
    files = file_reader(spark, suffix, since).format("binaryFile").load(folder)
    return modified_after(files, since).select("path", "modificationTime", "length")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return csv_reader(spark.read, schema).csv(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
