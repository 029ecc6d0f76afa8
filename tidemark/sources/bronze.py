"""Bronze: immutable gzipped JSON lines under date=YYYY-MM-DD/hour=HH."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.hours import Hour, days_of, in_hours
from tidemark.functions.keys import check_hour, parse_day
from tidemark.schemas import CORRUPT_RECORD, ENVELOPE, SOURCE_COLUMNS
from tidemark.sources.claims import claimed
from tidemark.sources.swaps import folders


def bronze_partition(day: str | date, hour: int) -> str:
    """Partition folder of an hour; bronze pads the hour to two digits."""
    return f"date={parse_day(day).isoformat()}/hour={check_hour(hour):02d}"


def _load(
    reader: DataFrameReader, kind: str, root: str, hours: Sequence[Hour] | None
) -> DataFrame:
    """Lines of the given hour files, or of all bronze, tagged with the file's hour.

    Only the folders asked for are listed. An hour that never landed is an error if it is the
    only one, and has no lines otherwise.
    """
    folder = root
    if hours is not None:
        days = ",".join(sorted(day.isoformat() for day in days_of(hours)))
        folder = f"{root}/date={{{days}}}"
        if len(hours) == 1:
            folder = f"{root}/{bronze_partition(*hours[0])}"
    lines = reader.option("basePath", root).format(kind).load(folder)
    values = [c for c in lines.columns if c not in ("date", "hour")]
    if hours is not None:
        lines = lines.where(in_hours(hours, ["date", "hour"]))
    return lines.select(
        *values,
        F.col("date").cast("date").alias("source_date"),
        F.col("hour").cast("int").alias("source_hour"),
    )


def read_bronze(
    spark: SparkSession,
    root: str,
    hours: Sequence[Hour] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Events as they were dumped, under a fixed schema.

    A line that is no JSON becomes a row of NULLs; ``keep_corrupt`` adds its text. One gzip
    file is one task, and the de-duplication that follows spreads its rows.
    """
    schema = ENVELOPE
    if keep_corrupt:
        schema = StructType([*ENVELOPE.fields, StructField(CORRUPT_RECORD, StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    return _load(reader, "json", root, hours)


def read_bronze_lines(
    spark: SparkSession, root: str, hours: Sequence[Hour] | None = None
) -> DataFrame:
    """Physical lines, blank ones too, not parsed."""
    return _load(spark.read, "text", root, hours)


def count_lines(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*SOURCE_COLUMNS).agg(F.count("*").alias("raw_rows"))


def land_bronze(lines: DataFrame, root: str) -> list[Hour]:
    """Land JSON lines (value, source_date, source_hour) once; returns the hours landed by this call.

    Hours already there are skipped, and so are those that another lander is writing: an hour is claimed first, which
    only one lander can do (``claims``). An hour is looked for again after it was claimed, as the one before may
    have ended in between. The dynamic overwrite moves each finished hour into place as a whole folder, so an hour
    that can be seen is complete and skipping it is safe.
    """
    spark = lines.sparkSession
    # calendar hours of what is to be landed: 24 for each of its days; a line without one lands nowhere
    named = lines.select(*SOURCE_COLUMNS).distinct().where("source_date IS NOT NULL AND source_hour IS NOT NULL")
    wanted = sorted((r.source_date, r.source_hour) for r in named.collect())
    days = ",".join(sorted(day.isoformat() for day in days_of(wanted)))

    def missing(hours: Sequence[Hour]) -> list[Hour]:
        landed = set(folders(spark, root, [f"date={{{days}}}", "hour=*"]))
        return [h for h in hours if bronze_partition(*h) not in landed]

    with claimed(spark, root, {bronze_partition(*h): h for h in missing(wanted)}) as hours:
        mine = missing(hours)
        if not mine:
            return []
        (
            lines.where(in_hours(mine, SOURCE_COLUMNS))
            .select(
                "value",
                F.date_format("source_date", "yyyy-MM-dd").alias("date"),
                F.lpad(F.col("source_hour").cast("string"), 2, "0").alias("hour"),
            )
            .hint("rebalance", "date", "hour")
            .write.partitionBy("date", "hour")
            .option("compression", "gzip")
            .option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .text(root)
        )
    return mine
