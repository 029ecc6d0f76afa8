"""Silver rows from landed lines as a stream, de-duplicated in state.

Copies of an event in one hour file are brought together by a stateful aggregate on (file hour, event id), with the
same choice among them as in the batch, so it does not matter how the file's lines fall into micro-batches. The
watermark is on the file's hour: an hour is given out once, when one has landed that is later by more than ``delay``, and
its state is dropped then. So the state holds the ids of the hours of the delay, however long the stream runs. An hour
that lands after that is late and is not taken; the hourly chain takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from tidemark.operators.silver import flatten, partition_columns, typed
from tidemark.schemas import ENVELOPE, SOURCE_COLUMNS

DELAY = "2 hours"
FILE_HOUR = "file_hour"


def stream_bronze(spark: SparkSession, root: str, files_per_batch: int = 100) -> DataFrame:
    """Lines of hour files as they land, tagged with the file's hour."""
    schema = StructType([*ENVELOPE.fields, StructField("date", DateType()), StructField("hour", IntegerType())])
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(root)
    return lines.withColumnsRenamed({"date": "source_date", "hour": "source_hour"})


def dedupe_within(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """One row per event id and hour file, once the hour is older than the delay: of copies the latest, as in the batch.

    Rows without an id are no copies of one another and cannot be held by one; the hourly chain puts them in quarantine.
    """
    hour = F.col("source_date").cast("timestamp") + F.make_dt_interval(hours=F.col("source_hour"))
    keys = [*SOURCE_COLUMNS, "event_id"]
    rest = ["created_at", *[c for c in events.columns if c not in (*keys, "created_at")]]
    timed = events.where("event_id IS NOT NULL").withColumn(FILE_HOUR, hour).withWatermark(FILE_HOUR, delay)
    kept = timed.groupBy(FILE_HOUR, *keys).agg(F.max(F.struct(*rest)).alias("kept"))
    return kept.select(*keys, "kept.*").select(*events.columns)


def stream_silver(
    spark: SparkSession, bronze: str, path: str, checkpoint: str, delay: str = DELAY, files_per_batch: int = 100
) -> StreamingQuery:
    """Write the silver rows of every hour that is older than the delay, then stop; the next call goes on from there."""
    events = partition_columns(typed(flatten(stream_bronze(spark, bronze, files_per_batch))))
    return (
        dedupe_within(events, delay)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*SOURCE_COLUMNS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
