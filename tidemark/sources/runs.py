"""Tables the pipeline writes about itself, by the day a record was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark.operators.runs import MAX_RUNS, is_well_formed, run_history
from tidemark.schemas import RUN_METADATA, RUN_RECORDS, RUN_SUMMARY
from tidemark.session import file_system
from tidemark.sources.swaps import folders
from tidemark.sources.tables import read_table, read_table_folders, replace_partitions, replace_table, stage

RUN_DAY = "run_day"
RUN_KEY = ["run_id", "recorded_at"]


def _by_day(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(RUN_DAY, DateType())])


def _with_day(rows: DataFrame, schema: StructType) -> DataFrame:
    return rows.select(*schema.fieldNames(), F.to_date("recorded_at").alias(RUN_DAY))


def _take_over(spark: SparkSession, path: str, schema: StructType) -> None:
    """Lay a table that an earlier version wrote out by day."""
    fs, at = file_system(spark, path)
    if fs.exists(at) and not folders(spark, path, [f"{RUN_DAY}=*"]):
        replace_table(_with_day(spark.read.schema(schema).parquet(path), schema), path, [RUN_DAY])


def _append(rows: DataFrame, path: str, schema: StructType) -> None:
    _take_over(rows.sparkSession, path, schema)
    _with_day(rows, schema).write.partitionBy(RUN_DAY).mode("append").parquet(path)


def append_runs(rows: DataFrame, path: str) -> None:
    """Append run rows under the declared schema, whatever is there; the table is created by the first one."""
    _append(rows, path, RUN_METADATA)


def record_runs(rows: DataFrame, path: str) -> int:
    """Add run rows that the table does not have yet, by run id and time of record; returns how many that were.

    A write that is repeated, as after a lost driver, so adds nothing, while a run that is run again gets another
    record. Only the days of the incoming rows are read, and rewritten if they grow.
    """
    spark = rows.sparkSession
    _take_over(spark, path, RUN_METADATA)
    incoming = stage(_with_day(rows, RUN_METADATA).dropDuplicates(RUN_KEY), "runs")
    days = [r[RUN_DAY] for r in incoming.select(RUN_DAY).distinct().collect()]
    known = read_run_days(spark, path, days)
    new = stage(incoming.join(known.select(*RUN_KEY), RUN_KEY, "left_anti"), "new-runs")
    added = new.count()
    if added:
        grown = F.col(RUN_DAY).isin([r[RUN_DAY] for r in new.select(RUN_DAY).distinct().collect()])
        whole = known.where(grown).unionByName(new)
        replace_partitions(whole, path, [RUN_DAY])
    return added


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, _by_day(RUN_METADATA)).select(*RUN_METADATA.fieldNames())


def read_run_days(spark: SparkSession, path: str, days: list) -> DataFrame:
    """Run rows of those days, with their day; no other folder is listed."""
    names = [day if isinstance(day, str) else day.isoformat() for day in days]
    return read_table_folders(spark, path, _by_day(RUN_METADATA), RUN_DAY, names)


def recent_runs(spark: SparkSession, path: str, limit: int = 10) -> DataFrame:
    """``run_history`` of the newest days that hold enough well-formed runs, whatever the table's age.

    Days are taken newest first, twice as many at a time; a day's folder names what it holds, so those before
    are not read.
    """
    if not 1 <= limit <= MAX_RUNS:
        raise ValueError(f"limit must be 1..{MAX_RUNS}, got {limit}")
    _take_over(spark, path, RUN_METADATA)
    days = sorted((f.split("=")[1] for f in folders(spark, path, [f"{RUN_DAY}=*"])), reverse=True)
    taken = 1
    while taken < len(days):
        newest = read_run_days(spark, path, days[:taken])
        if newest.where(is_well_formed()).limit(limit).count() == limit:
            break
        taken *= 2
    return run_history(read_run_days(spark, path, days[:taken]).drop(RUN_DAY), limit)


def append_run_records(records: DataFrame, path: str) -> None:
    """Append records as they were logged, with VARIANT tasks and summary."""
    _append(records, path, RUN_RECORDS)


def read_run_records(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, _by_day(RUN_RECORDS)).select(*RUN_RECORDS.fieldNames())


def append_summaries(verdict: DataFrame, path: str) -> None:
    verdict.select(*RUN_SUMMARY.fieldNames()).write.mode("append").parquet(path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RUN_SUMMARY)
