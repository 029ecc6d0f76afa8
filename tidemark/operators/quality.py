"""Data-quality checks. Each returns its failing rows, a one-row result, or a verdict per hour."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import CONTRIBUTION_TYPES, SILVER_COLUMNS, STAR_TYPE
from tidemark.session import as_utc


class QualityGateError(Exception):
    """At least one hour failed its checks; nothing after the gate may run."""


# Row checks


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the domain with their row counts; NULL is left to ``not_null``."""
    per_value = df.groupBy(column).agg(F.count("*").alias("n"))
    return per_value.where(~F.col(column).isin(list(values)))


def accepted_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows outside low..high, both inclusive; NULL is left to ``not_null``."""
    return df.where(~F.col(column).between(low, high))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys with no parent, and their row counts.

    The child is reduced to its distinct keys before the join, so a hot key is one row there.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("n"))
    return keys.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def orphan_keys(child: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """All foreign keys of a table at once: (fk, value, n) of those with no parent.

    ``parents`` maps each key column to the frame that must hold it under the same name. The
    child is scanned once for all of them, and again only its distinct keys are joined.
    """
    pairs = [
        F.struct(F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("value")) for fk in parents
    ]
    keys = (
        child.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .where("value IS NOT NULL")
        .groupBy("fk", "value")
        .agg(F.count("*").alias("n"))
    )
    known = stack(
        [
            parent.select(F.lit(fk).alias("fk"), F.col(fk).cast("string").alias("value"))
            for fk, parent in parents.items()
        ]
    )
    return keys.join(known, ["fk", "value"], "left_anti")


def freshness(
    df: DataFrame,
    column: str,
    as_of: datetime,
    warn: timedelta = timedelta(hours=12),
    error: timedelta = timedelta(hours=24),
) -> DataFrame:
    """Age of the newest row at ``as_of`` and its status; an empty table is an error."""
    newest = df.agg(F.max(column).alias("max_loaded_at"))
    age = F.unix_timestamp(F.lit(as_utc(as_of))) - F.unix_timestamp("max_loaded_at")
    status = (
        F.when(age <= int(warn.total_seconds()), "pass")
        .when(age <= int(error.total_seconds()), "warn")
        .otherwise("error")
    )
    return newest.select("max_loaded_at", age.alias("age_seconds"), status.alias("status"))


def columns_match_set(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row: the table's size and whether its columns are exactly ``names``, in any order."""
    missing, extra = set(names) - set(df.columns), set(df.columns) - set(names)
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count",
        F.lit(",".join(sorted(missing))).alias("missing"),
        F.lit(",".join(sorted(extra))).alias("unexpected"),
        F.lit(not missing and not extra).alias("success"),
    )


def _rate_ok(non_null: str | Column, rows: str | Column, mostly: float) -> Column:
    """An empty table has no NULLs, so it passes."""
    return F.coalesce(F.try_divide(non_null, rows) >= F.lit(mostly), F.lit(True))


def null_rate(df: DataFrame, columns: Sequence[str], mostly: float = 0.9999) -> DataFrame:
    """Per column: rows, non-NULL rows, and whether at least ``mostly`` of them have a value."""
    counts = df.agg(F.count("*").alias("row_count"), *[F.count(c).alias(c) for c in columns])
    rates = counts.unpivot(["row_count"], list(columns), "column_name", "non_null")
    return rates.withColumn(
        "success", _rate_ok(F.col("non_null"), F.col("row_count"), mostly)
    )


def row_count_between(df: DataFrame, low: int = 50_000, high: int = 900_000) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn(
        "success", F.col("row_count").between(low, high)
    )


def values_unique(df: DataFrame, column: str) -> DataFrame:
    """One row: values, distinct values, and whether no value repeats."""
    counts = df.agg(F.count(column).alias("n"), F.countDistinct(column).alias("n_distinct"))
    return counts.withColumn("success", F.col("n") == F.col("n_distinct"))


def quarantine_zero(bad: DataFrame) -> DataFrame:
    return bad.agg(F.count("*").alias("quarantine_rows")).withColumn(
        "success", F.col("quarantine_rows") == 0
    )


# Conservation of rows: raw = hour + quarantine + residual


def compute_residual(raw: Column, hour_rows: Column, quarantine: Column) -> Column:
    return raw - hour_rows - quarantine


def residual_ok(residual: Column, raw: Column, threshold: float = 0.0001) -> Column:
    """True when the rows unaccounted for are few and not negative; no raw rows is a failure."""
    share = F.try_divide(residual, raw)
    return F.coalesce((raw > 0) & (share <= F.lit(threshold)) & (residual >= 0), F.lit(False))


def residual(
    raw: DataFrame, silver: DataFrame, bad: DataFrame, threshold: float = 0.0001
) -> DataFrame:
    """The identity over three whole tables, one row."""
    counted = [
        df.agg(F.count("*").alias(name))
        for df, name in (
            (raw, "raw_rows"),
            (silver, "hour_rows"),
            (bad, "quarantine_rows"),
        )
    ]
    names = ["raw_rows", "hour_rows", "quarantine_rows"]
    totals = stack(counted).agg(*[F.sum(n).alias(n) for n in names])
    rest = compute_residual(*[F.col(n) for n in names])
    return totals.withColumn("residual_rows", rest).withColumn(
        "residual_check", residual_ok(F.col("residual_rows"), F.col("raw_rows"), threshold)
    )


def stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# The whole suite


@dataclass(frozen=True)
class SuiteBounds:
    """Limits of the hourly suite; the defaults suit a full-size hour."""

    min_rows: int = 50_000
    max_rows: int = 900_000
    mostly: float = 0.9999
    residual_threshold: float = 0.0001


_METRICS = ["hour_rows", "ids", "distinct_ids", "types", "times", "actors", "repos"]


def hour_metrics(
    raw: DataFrame, silver: DataFrame, bad: DataFrame, late: DataFrame | None = None
) -> DataFrame:
    """Counts per hour: one scan of each input, no join.

    Raw and quarantined rows are counted under the hour file they came from, silver rows under
    the hour of their timestamp. ``late`` rows came in one file and lie in another hour; they
    are counted under both, so that each hour's balance can be drawn for its own file.
    """
    by_source = [
        F.col("source_date").alias("partition_date"),
        F.col("source_hour").alias("partition_hour"),
    ]
    by_event = [
        F.col("event_date").alias("partition_date"),
        F.col("event_hour").alias("partition_hour"),
    ]
    parts = [
        raw.groupBy(*by_source).agg(F.count("*").alias("raw_rows")),
        bad.groupBy(*by_source).agg(F.count("*").alias("quarantine_rows")),
        silver.groupBy(*by_event).agg(
            F.count("*").alias("hour_rows"),
            F.count("event_id").alias("ids"),
            F.countDistinct("event_id").alias("distinct_ids"),
            F.count("event_type").alias("types"),
            F.count("created_at").alias("times"),
            F.count("actor_id").alias("actors"),
            F.count("repo_id").alias("repos"),
        ),
    ]
    names = ["raw_rows", "quarantine_rows", *_METRICS]
    if late is not None:
        names += ["late_sent", "late_received"]
        parts += [
            late.groupBy(*by_source).agg(F.count("*").alias("late_sent")),
            late.groupBy(*by_event).agg(F.count("*").alias("late_received")),
        ]
    return (
        stack(parts)
        .groupBy("partition_date", "partition_hour")
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    )


def suite_verdict(
    raw: DataFrame,
    silver: DataFrame,
    bad: DataFrame,
    recorded_at: datetime,
    bounds: SuiteBounds = SuiteBounds(),
    quarantine_scope: str = "hour",
    expected_columns: Sequence[str] = SILVER_COLUMNS,
    late: DataFrame | None = None,
) -> DataFrame:
    """Run summary of every hour found in the inputs.

    ``quarantine_scope='table'`` charges every hour with all quarantined rows, so one bad row
    turns all hours red; 'hour' charges each hour with the rows its own file produced.
    """
    if quarantine_scope not in ("hour", "table"):
        raise ValueError("quarantine_scope must be 'hour' or 'table'")
    counts = hour_metrics(raw, silver, bad, late)
    if quarantine_scope == "table":
        everything = bad.agg(F.count("*")).scalar()
        counts = counts.withColumn("quarantine_rows", everything)
    columns = set(silver.columns) - {"event_date", "event_hour"}
    suite = (
        F.lit(columns == set(expected_columns))
        & (F.col("ids") == F.col("hour_rows"))
        & (F.col("types") == F.col("hour_rows"))
        & (F.col("times") == F.col("hour_rows"))
        & (F.col("ids") == F.col("distinct_ids"))
        & _rate_ok(F.col("actors"), F.col("hour_rows"), bounds.mostly)
        & _rate_ok(F.col("repos"), F.col("hour_rows"), bounds.mostly)
        & F.col("hour_rows").between(bounds.min_rows, bounds.max_rows)
    )
    kept = F.col("hour_rows")
    if late is not None:
        kept = kept + F.col("late_sent") - F.col("late_received")
    rest = compute_residual(F.col("raw_rows"), kept, F.col("quarantine_rows"))
    checked = counts.withColumn("residual_rows", rest).select(
        "raw_rows",
        "hour_rows",
        "quarantine_rows",
        "residual_rows",
        (F.col("quarantine_rows") == 0).alias("quarantine_check"),
        residual_ok(F.col("residual_rows"), F.col("raw_rows"), bounds.residual_threshold).alias(
            "residual_check"
        ),
        suite.alias("great_expectations_suite_check"),
        "partition_date",
        "partition_hour",
    )
    passed = (
        F.col("great_expectations_suite_check")
        & F.col("residual_check")
        & F.col("quarantine_check")
    )
    return checked.withColumn("pipeline_check", passed).withColumn(
        "timestamp", F.lit(as_utc(recorded_at))
    )


def blocked_hours(verdict: DataFrame) -> DataFrame:
    return verdict.where(~F.col("pipeline_check"))


def gate(verdict: DataFrame) -> None:
    """Raise when an hour is red. A few red hours are named in the message."""
    red = blocked_hours(verdict).select("partition_date", "partition_hour").limit(5).collect()
    if red:
        hours = ", ".join(f"{r.partition_date} {r.partition_hour:02d}h" for r in red)
        raise QualityGateError(f"quality gate failed, among others for: {hours}")


def mart_reconciliation(
    fact: DataFrame,
    dim_repo: DataFrame,
    trending: DataFrame,
    momentum: DataFrame,
    leaderboard: DataFrame,
) -> DataFrame:
    """Each mart's total beside the fact count it must equal. The fact is scanned once."""
    names = ["stars", "event_count", "contributions", "repos"]
    facts = fact.agg(
        F.count_if(F.col("event_type") == STAR_TYPE).alias("stars"),
        F.count("*").alias("event_count"),
        F.count_if(F.col("event_type").isin(CONTRIBUTION_TYPES)).alias("contributions"),
        F.countDistinct("repo_sk").alias("repos"),
    )
    marts = stack(
        [
            trending.agg(F.sum("stars").alias("stars")),
            momentum.agg(F.sum("event_count").alias("event_count")),
            leaderboard.agg(F.sum("contributions").alias("contributions")),
            dim_repo.agg(F.count("*").alias("repos")),
        ]
    ).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    sides = facts.withColumn("side", F.lit("fact")).unionByName(
        marts.withColumn("side", F.lit("mart"))
    )
    return (
        sides.unpivot(["side"], names, "measure", "total")
        .groupBy("measure")
        .agg(
            F.sum(F.when(F.col("side") == "fact", F.col("total"))).alias("fact_total"),
            F.sum(F.when(F.col("side") == "mart", F.col("total"))).alias("mart_total"),
        )
        .withColumn("success", F.col("fact_total") == F.col("mart_total"))
    )
