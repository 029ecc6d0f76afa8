"""Run the hourly chain on hour files as they land.

The hourly schedule is a stream here: Structured Streaming's file source remembers which files
it has seen, so an hour is run once when it lands and again only if another file for it does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.hours import as_hour
from tidemark.operators.quality import QualityGateError, SuiteBounds
from tidemark.plans.hourly import run_hours
from tidemark.plans.lake import Lake

# Only the folder names are used; a file's content is never read through this.
_FILES = (
    "path string, modificationTime timestamp, length bigint, content binary, "
    "date date, hour int"
)


def run_landed_hours(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    bounds: SuiteBounds = SuiteBounds(),
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Process every hour file that has landed since the last call, then stop.

    A batch that is repeated after a failure rewrites the same partitions. An hour that fails
    the gate is in the run history and does not stop the stream.
    """

    def run(files: DataFrame, _batch: int) -> None:
        hours = sorted(
            as_hour(r["date"], r["hour"]) for r in files.select("date", "hour").distinct().collect()
        )
        if hours:
            try:
                run_hours(files.sparkSession, lake, hours, bounds=bounds)
            except QualityGateError as red:
                print(red)

    return (
        spark.readStream.schema(_FILES)
        .format("binaryFile")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(lake.bronze)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
