"""Run metadata: one row per pipeline run, and its history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import RUN_COUNTS, RUN_METADATA, RUN_SUMMARY, TASKS

MAX_RUNS = 100


def fresh_summaries(runs: DataFrame, summaries: DataFrame) -> DataFrame:
    """Runs with the summary of their own hour, or NULL.

    Only the last summary of an hour counts, and only if it was written after the run started.
    ``runs``: run_id, run_start, logical_date, recorded_at.
    """
    fields = F.struct(*RUN_SUMMARY.fieldNames())
    last = (
        summaries.groupBy("partition_date", "partition_hour")
        .agg(F.max_by(fields, "timestamp").alias("summary"))
        .withColumnsRenamed({"partition_date": "run_date", "partition_hour": "run_hour"})
    )
    hours = runs.withColumn("run_date", F.to_date("logical_date")).withColumn(
        "run_hour", F.hour("logical_date")
    )
    is_fresh = F.col("summary.timestamp") > F.col("run_start")
    return (
        hours.join(last, ["run_date", "run_hour"], "left")
        .withColumn("summary", F.when(is_fresh, F.col("summary")))
        .drop("run_date", "run_hour")
    )


def run_tasks(tasks: DataFrame) -> DataFrame:
    """The tasks of each run as an array; a run has a handful of them.

    They are in the order of ``position`` if there is such a column, else of their ids.
    """
    fields = ["task_id", "state", F.col("duration").cast("double").alias("duration")]
    if "position" not in tasks.columns:
        listed = F.array_sort(F.collect_list(F.struct(*fields)))
    else:
        placed = F.array_sort(F.collect_list(F.struct("position", F.struct(*fields).alias("task"))))
        listed = F.transform(placed, lambda x: x["task"])
    return tasks.groupBy("run_id").agg(listed.alias("tasks"))


def run_rows(runs: DataFrame, tasks: DataFrame, summaries: DataFrame) -> DataFrame:
    """Metadata rows. Without a fresh summary the counts are NULL, but the run is recorded."""
    return (
        fresh_summaries(runs, summaries)
        .join(run_tasks(tasks), "run_id", "left")
        .select(
            "run_id",
            "recorded_at",
            "logical_date",
            *[F.col(f"summary.{c}").alias(c) for c in RUN_COUNTS],
            F.col("tasks").cast(TASKS).alias("tasks"),
            F.col("summary").cast(RUN_SUMMARY).alias("run_summary_json"),
        )
        .select(*RUN_METADATA.fieldNames())
    )


def run_verdict() -> Column:
    """NULL when the run has no summary or the summary has no verdict."""
    return F.col("run_summary_json.pipeline_check")


def _is_malformed() -> Column:
    bad_task = F.exists("tasks", lambda t: t["task_id"].isNull() | t["state"].isNull())
    return F.coalesce(bad_task, F.lit(False))


def is_well_formed() -> Column:
    return ~_is_malformed()


def run_history(meta: DataFrame, limit: int = 10, latest_only: bool = False) -> DataFrame:
    """Newest well-formed runs. ``latest_only`` keeps the last record of a retried run."""
    if not 1 <= limit <= MAX_RUNS:
        raise ValueError(f"limit must be 1..{MAX_RUNS}, got {limit}")
    if latest_only:
        last = F.max_by(F.struct(*meta.columns), "recorded_at").alias("last")
        meta = meta.groupBy("run_id").agg(last).select("last.*")
    return (
        meta.where(is_well_formed())
        .select(
            "run_id",
            "logical_date",
            F.coalesce("tasks", F.array().cast(TASKS)).alias("tasks"),
            *RUN_COUNTS,
            "recorded_at",
            run_verdict().alias("verdict"),
        )
        .orderBy(F.desc("recorded_at"), F.desc("run_id"))
        .limit(limit)
    )


def run_errors(meta: DataFrame) -> DataFrame:
    """Runs whose tasks lack a task id or a state. They are listed, never dropped unseen."""
    return meta.where(_is_malformed()).select(
        "run_id", F.lit("a task lacks task_id or state").alias("reason")
    )
