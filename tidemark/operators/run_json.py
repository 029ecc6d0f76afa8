"""Run records as they were logged: tasks and summary as VARIANT, where a field that is absent differs from a NULL.

A record is well-formed if each task has a text ``task_id``, a text ``state`` and a ``duration`` that is a number
or NULL. A task without the field ``duration`` is malformed: an older logger left it out where it was not known,
so nothing says that the task did not end. ``run_errors`` gives the first reason that a record is malformed for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import runs
from tidemark.schemas import RUN_COUNTS, TASKS

ABSENT, NULL, VALUE, INVALID = "absent", "null", "value", "invalid"


def parse_records(records: DataFrame, columns: dict[str, str]) -> DataFrame:
    """JSON text to VARIANT, by new name and text column. Text that is no JSON becomes a JSON string of itself, so
    that it is found malformed instead of missing."""

    def parsed(text: str) -> Column:
        quoted = F.try_variant_get(F.try_parse_json(F.to_json(F.array(text))), "$[0]", "variant")
        return F.coalesce(F.try_parse_json(text), F.when(F.col(text).isNotNull(), quoted))

    return records.withColumns({name: parsed(text) for name, text in columns.items()}).drop(*columns.values())


def field(value: Column, path: str) -> Column:
    """The field as a VARIANT; SQL NULL only if it is absent."""
    return F.try_variant_get(value, path, "variant")


def kind_of(value: Column, path: str, as_type: str) -> Column:
    """Whether the field is absent, a JSON null, a value that reads as the type, or something else."""
    found = field(value, path)
    # anything can be cast to text
    fits = F.try_variant_get(value, path, as_type).isNotNull()
    if as_type == "string":
        fits = F.schema_of_variant(found) == "STRING"
    return (
        F.when(found.isNull(), ABSENT)
        .when(F.is_variant_null(found), NULL)
        .when(fits, VALUE)
        .otherwise(INVALID)
    )


def is_list(tasks: Column) -> Column:
    return F.try_variant_get(tasks, "$", "array<variant>").isNotNull()


def _empty(tasks: Column) -> Column:
    return tasks.isNull() | F.is_variant_null(tasks)


def listed(tasks: Column) -> Column:
    """The tasks one by one, as VARIANT; none for a record without any."""
    return F.coalesce(F.try_variant_get(tasks, "$", "array<variant>"), F.array().cast("array<variant>"))


def typed(task: Column) -> Column:
    return F.struct(
        F.try_variant_get(task, "$.task_id", "string").alias("task_id"),
        F.try_variant_get(task, "$.state", "string").alias("state"),
        F.try_variant_get(task, "$.duration", "double").alias("duration"),
    )


def _task_problem(task: Column, at: Column) -> Column:
    """The first thing that is wrong with a task, or NULL."""

    def wrong(name: str, as_type: str, accepted: list[str]) -> Column:
        kind = kind_of(task, f"$.{name}", as_type)
        where = F.format_string(f"tasks[%d].{name} is %s", at, kind)
        return F.when(~kind.isin(accepted), where)

    return F.coalesce(
        wrong("task_id", "string", [VALUE]),
        wrong("state", "string", [VALUE]),
        wrong("duration", "double", [VALUE, NULL]),
    )


def problem(tasks: Column) -> Column:
    """Why a record's tasks are malformed, or NULL where they are not."""
    each = F.transform(listed(tasks), _task_problem)
    first = F.get(F.filter(each, lambda p: p.isNotNull()), F.lit(0))
    return F.when(_empty(tasks), None).when(~is_list(tasks), "tasks is no list").otherwise(first)


def verdict(summary: Column) -> Column:
    """NULL when there is no summary, or no verdict in it."""
    return F.try_variant_get(summary, "$.pipeline_check", "boolean")


def task_durations(records: DataFrame) -> DataFrame:
    """One row for each task: its duration and whether that is a value, a NULL or absent."""
    tasks = records.select("run_id", F.posexplode(listed(F.col("tasks"))).alias("pos", "task"))
    task = F.col("task")
    return tasks.select("run_id", "pos", kind_of(task, "$.duration", "double").alias("duration_kind"), typed(task).alias("t")).select(
        "run_id", "pos", "t.task_id", "t.state", "t.duration", "duration_kind"
    )


def run_history(records: DataFrame, limit: int = 10) -> DataFrame:
    """Newest well-formed records, with typed tasks."""
    if not 1 <= limit <= runs.MAX_RUNS:
        raise ValueError(f"limit must be 1..{runs.MAX_RUNS}, got {limit}")
    good = records.where(problem(F.col("tasks")).isNull())
    return (
        good.select(
            "run_id",
            "logical_date",
            F.transform(listed(F.col("tasks")), typed).cast(TASKS).alias("tasks"),
            *RUN_COUNTS,
            "recorded_at",
            verdict(F.col("run_summary_json")).alias("verdict"),
        )
        .orderBy(F.desc("recorded_at"), F.desc("run_id"))
        .limit(limit)
    )


def run_errors(records: DataFrame) -> DataFrame:
    """(run_id, reason) of every malformed record."""
    return records.select("run_id", problem(F.col("tasks")).alias("reason")).where("reason IS NOT NULL")
