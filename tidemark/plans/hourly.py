"""The chain for landed hours: silver, gate, load, gold, run record."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hours import Hour, as_hour, days_of, in_hours
from tidemark.operators import bitmaps, quality, runs
from tidemark.operators.silver import transform_events
from tidemark.plans.gold import refresh_gold
from tidemark.plans.lake import Lake
from tidemark.schemas import QUARANTINE, SOURCE_COLUMNS
from tidemark.session import scratch_scope, shuffles_for, use_utc
from tidemark.sources.bronze import read_bronze, read_bronze_lines
from tidemark.sources.runs import append_summaries, read_summaries
from tidemark.sources.runs import record_runs as keep_runs
from tidemark.sources.silver import (
    load_hours,
    loaded_hours,
    read_bitmaps,
    read_late,
    read_silver_hours,
    write_bitmaps,
    write_silver_hours,
)
from tidemark.sources.swaps import finish_swaps
from tidemark.sources.tables import read_table, stage


# An hour of about 1 GB of JSON is some 83 MB of gzip.
GZIP_EXPANSION = 12


def _now() -> datetime:
    return datetime.now(timezone.utc)


def finish_pending(spark: SparkSession, lake: Lake) -> dict[str, list[str]]:
    """Finish the swaps that a run which did not end has left in any table; returns the partitions moved."""
    moved = {path: finish_swaps(spark, path, depth) for path, depth in lake.partitioned.items()}
    return {path: folders for path, folders in moved.items() if folders}


def to_silver(spark: SparkSession, lake: Lake, hours: Sequence[Hour]) -> list[Hour]:
    """Returns the event hours rewritten: the given ones, and others their late rows belong to."""
    raw = read_bronze(spark, lake.bronze, hours, keep_corrupt=True)
    with shuffles_for(raw, expansion=GZIP_EXPANSION):
        return write_silver_hours(transform_events(raw), lake.silver, hours)


def verdict(
    spark: SparkSession,
    lake: Lake,
    hours: Sequence[Hour],
    recorded_at: datetime,
    bounds: quality.SuiteBounds = quality.SuiteBounds(),
) -> DataFrame:
    """Run summary of the given hours."""
    bad = read_table(
        spark, lake.silver.quarantine, QUARANTINE, "source_date", days_of(hours)
    )
    rows = quality.suite_verdict(
        read_bronze_lines(spark, lake.bronze, hours),
        read_silver_hours(spark, lake.silver.events, hours),
        bad.where(in_hours(hours, SOURCE_COLUMNS)),
        recorded_at,
        bounds,
        late=read_late(spark, lake.silver.late, received=hours, sent=hours),
    )
    return rows.where(in_hours(hours, ["partition_date", "partition_hour"]))


def validate(
    spark: SparkSession, lake: Lake, hours: Sequence[Hour], bounds: quality.SuiteBounds
) -> set[Hour]:
    """Record the summaries and return the hours that passed."""
    rows = stage(verdict(spark, lake, hours, _now(), bounds), "verdict")
    append_summaries(rows, lake.summaries)
    passed = rows.where("pipeline_check").select("partition_date", "partition_hour").collect()
    return {as_hour(r.partition_date, r.partition_hour) for r in passed}


class _TaskLog:
    """What became of each step, for each hour."""

    def __init__(self, hours: Sequence[Hour], steps: Sequence[str]):
        self.steps = steps
        self.tasks: dict[Hour, list[tuple[str, str, float | None]]] = {h: [] for h in hours}

    def run(self, step: str, hours: Sequence[Hour], work: Callable[[], object]):
        begun, state = time.monotonic(), "failed"
        try:
            result = work()
            state = "success"
            return result
        finally:
            for hour in hours:
                self.tasks[hour].append((step, state, time.monotonic() - begun))

    def fail(self, hour: Hour) -> None:
        step, _, duration = self.tasks[hour].pop()
        self.tasks[hour].append((step, "failed", duration))

    def rows(self, hour: Hour) -> list[tuple[str, str, float | None]]:
        ran = self.tasks[hour]
        missing = self.steps[len(ran) :]
        return [*ran, *[(step, "upstream_failed", None) for step in missing]]


def run_hours(
    spark: SparkSession,
    lake: Lake,
    hours: Sequence[Hour],
    kind: str = "scheduled",
    bounds: quality.SuiteBounds = quality.SuiteBounds(),
    full_refresh: bool = False,
) -> None:
    """Take landed hours to gold in one go.

    An hour that fails the gate stops there while the others go on, as separate runs of them
    would; the error is raised at the end. Every hour's run is recorded, whatever happens.
    """
    use_utc(spark)
    finish_pending(spark, lake)
    with scratch_scope(spark):
        _run_hours(spark, lake, hours, kind, bounds, full_refresh)


def _run_hours(
    spark: SparkSession,
    lake: Lake,
    hours: Sequence[Hour],
    kind: str,
    bounds: quality.SuiteBounds,
    full_refresh: bool,
) -> None:
    started = _now()
    log = _TaskLog(hours, ["silver_transform", "validate_silver", "load_silver", "build_gold"])
    try:
        rewritten = log.run("silver_transform", hours, lambda: to_silver(spark, lake, hours))
        green = log.run("validate_silver", hours, lambda: validate(spark, lake, hours, bounds))
        red = [hour for hour in hours if hour not in green]
        for hour in red:
            log.fail(hour)
        passed = [hour for hour in hours if hour in green]
        if passed:
            # late rows also changed hours of earlier runs; those not loaded yet stay out
            others = [hour for hour in rewritten if hour not in hours]
            changed = [*passed, *sorted(loaded_hours(spark, lake.silver_events, others))]
            loaded = read_silver_hours(spark, lake.silver.events, changed)
            log.run("load_silver", passed, lambda: _load(spark, lake, loaded, changed))
            log.run(
                "build_gold", passed, lambda: refresh_gold(spark, lake, changed, full_refresh)
            )
        if red:
            names = ", ".join(f"{day} {hour:02d}h" for day, hour in red)
            raise quality.QualityGateError(f"quality gate failed for: {names}")
    finally:
        record_runs(spark, lake, kind, started, {hour: log.rows(hour) for hour in hours})


def _load(spark: SparkSession, lake: Lake, loaded: DataFrame, hours: Sequence[Hour]) -> None:
    """The hours to the warehouse table, and their id bitmaps beside it."""
    load_hours(loaded, lake.silver_events, hours)
    write_bitmaps(read_silver_hours(spark, lake.silver_events, hours), lake.id_bitmaps, hours)


def loaded_totals(spark: SparkSession, lake: Lake, hours: Sequence[Hour] | None = None) -> DataFrame:
    """Rows and distinct ids of the warehouse table, of some hours or all, from the stored bitmaps."""
    return bitmaps.distinct_ids(read_bitmaps(spark, lake.id_bitmaps, hours))


def record_runs(
    spark: SparkSession,
    lake: Lake,
    kind: str,
    started: datetime,
    tasks: dict[Hour, list[tuple[str, str, float | None]]],
) -> None:
    """One metadata row per hour of this run."""
    recorded = _now()
    ids = {
        (day, hour): datetime(day.year, day.month, day.day, hour, tzinfo=timezone.utc)
        for day, hour in tasks
    }
    run_frame = spark.createDataFrame(
        [(f"{kind}__{at.isoformat()}", started, at, recorded) for at in ids.values()],
        "run_id string, run_start timestamp, logical_date timestamp, recorded_at timestamp",
    )
    task_frame = spark.createDataFrame(
        [
            (f"{kind}__{ids[h].isoformat()}", i, *task)
            for h, rows in tasks.items()
            for i, task in enumerate(rows)
        ],
        "run_id string, position int, task_id string, state string, duration double",
    )
    recent = read_summaries(spark, lake.summaries).where(F.col("timestamp") > F.lit(started))
    keep_runs(runs.run_rows(run_frame, task_frame, recent), lake.runs)
