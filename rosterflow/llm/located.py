"""Rows told apart by their place in files, whatever their ids."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.session import stage


def located(docs: DataFrame) -> DataFrame:
    """``docs`` if read straight from files, else a written copy: both know each row's file and place in it."""
    try:
        docs.select("_metadata.row_index")
        return docs
    except AnalysisException:
        return stage(docs, "located")


def locator() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of located ``docs`` whose place is not in ``dropped`` (at)."""
    gone = "gone"
    while gone in docs.columns:
        gone += "_"
    return docs.join(dropped.select(F.col("at").alias(gone)), locator() == F.col(gone), "left_anti")
