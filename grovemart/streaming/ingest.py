"""Landed files into the history as they come: a file stream that starts the batch conversion.

The stream tells that something arrived; what is taken in are whole deliveries, by the same listing,
log as in the batch job. So a delivery that comes again replaces its day, a file
corrected under its old name is seen, and the star can be built from what the stream kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from grovemart.plans import jobs

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arrivals(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """A stream of the paths of files that arrive below a folder; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(root)
        .select("path")
    )


def ingest_available(spark: SparkSession, lake: jobs.Lake, checkpoint: str, run: str | None = None) -> list[tuple]:
    """Take in what has landed since the last time, then stop; returns the rejections.

    A last conversion finds files that a stream of new names does not see.
    """
    run = run or jobs.new_run()
    rejected: list[tuple] = []

    def take(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            rejected.extend(jobs.take_in(spark, lake, f"{run}-{number}")[1])

    query: StreamingQuery = (
        arrivals(spark, lake.landing)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not jobs.nothing_pending(spark, lake):
        rejected.extend(jobs.take_in(spark, lake, f"{run}-last")[1])
    return rejected
