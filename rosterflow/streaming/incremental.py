"""Applicant files as they arrive: a checkpointed alternative to a "modified since" time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.plans.applicants import continue_applicants
from rosterflow.session import stage
from rosterflow.sources.applicants import applicant_rows, clean_applicants
from rosterflow.sources.files import with_row_count, with_split

STORED = {
    "recruiters": "recruiter_id long, recruiter_name string, batch_id long",
    "location": "location_id long, address string, postcode string, city string, applicant_id string, batch_id long",
}


def run_applicant_updates(spark: SparkSession, raw_dir: str, target: str, checkpoint: str) -> None:
    """Process all files not seen before, then stop.

    Each micro-batch writes its own ``batch_id`` folder and continues the ids of earlier batches
    only, so a batch that is run again after a failure overwrites its own rows with the same ids.
    """
    reader = spark.readStream.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    files = with_split(reader.option("lineSep", "\n").text(f"{raw_dir}/Talent"))

    def store(batch: DataFrame, batch_id: int) -> None:
        rows, rejects = applicant_rows(stage(with_row_count(batch), "csv-lines-batch"))
        rejects.write.mode("overwrite").parquet(f"{target}/rejects/batch_id={batch_id}")
        applicants = stage(clean_applicants(rows), "applicants-batch")
        current = {name: _stored(batch.sparkSession, target, name, batch_id) for name in STORED}
        for name, df in continue_applicants(applicants, current).items():
            df.write.mode("overwrite").parquet(f"{target}/{name}/batch_id={batch_id}")

    query = (
        files.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _stored(spark: SparkSession, target: str, name: str, before: int) -> DataFrame:
    """Rows of earlier batches; empty before the first one."""
    if before == 0:
        return spark.createDataFrame([], STORED[name]).drop("batch_id")
    stored = spark.read.schema(STORED[name]).parquet(f"{target}/{name}")
    return stored.where(F.col("batch_id") < before).drop("batch_id")
