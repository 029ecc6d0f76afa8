"""Bronze envelope to typed, de-duplicated silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import CORRUPT_RECORD, RAW_TEXT, SOURCE_COLUMNS


def flatten(raw: DataFrame) -> DataFrame:
    """Lift the nested actor and repo fields; every field not listed is dropped.

    Bronze read with ``keep_corrupt`` gives a column with the text of lines that are no events. A line
    with only a field of the wrong type counts as parsed, with NULL in that field.
    """
    source = [c for c in SOURCE_COLUMNS if c in raw.columns]
    if CORRUPT_RECORD in raw.columns:
        nothing_parsed = F.coalesce("id", "type", "created_at").isNull()
        source.append(F.when(nothing_parsed, F.col(CORRUPT_RECORD)).alias(RAW_TEXT))
    return raw.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        "public",
        "created_at",
        *source,
    )


def typed(flat: DataFrame) -> DataFrame:
    """ISO text to timestamp. Text that is no timestamp becomes NULL also under ANSI mode."""
    return flat.withColumn("created_at", F.try_to_timestamp("created_at"))


def partition_columns(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("created_at")).withColumn(
        "event_hour", F.hour("created_at")
    )


def dedupe(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per key and hour file: the copy with the latest parsable timestamp, other columns breaking ties.

    Copies in different hour files stay apart, as separate runs of those files would keep them. Rows with
    a NULL key are no copies of one another and all stay.

    The choice depends only on the rows, so a stage that is run again after a lost executor
    keeps the same copy. Copies collapse in the map-side aggregate, so a key with very many
    copies sends one row per map task.
    """
    keys = [*[c for c in SOURCE_COLUMNS if c in events.columns], key]
    rest = ["created_at", *[c for c in events.columns if c not in (*keys, "created_at")]]
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    kept = (
        events.withColumn("alone", alone)
        .groupBy(*keys, "alone")
        .agg(F.max(F.struct(*rest)).alias("kept"))
    )
    return kept.select(*keys, "kept.*").select(*events.columns)


def transform_events(raw: DataFrame) -> DataFrame:
    return dedupe(partition_columns(typed(flatten(raw))))


def is_bad() -> Column:
    """Rows that silver cannot hold: without a time, or without an id to tell them apart."""
    return F.col("created_at").isNull() | F.col("event_id").isNull()


def split_quarantine(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a timestamp and an id, the others)."""
    return events.where(~is_bad()).drop(RAW_TEXT), events.where(is_bad())


def row_kind(events: DataFrame) -> DataFrame:
    """Tag each row against its source hour: 'own', 'late' (another hour), or 'bad' (no time or no id)."""
    own = (F.col("event_date") == F.col("source_date")) & (
        F.col("event_hour") == F.col("source_hour")
    )
    return events.withColumn(
        "row_kind",
        F.when(is_bad(), "bad").when(own, "own").otherwise("late"),
    )


def stg_events(silver: DataFrame) -> DataFrame:
    """Staging projection; date and hour are derived from the timestamp, not from the path."""
    return silver.select(
        "event_id",
        "event_type",
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        "public",
        "created_at",
        F.to_date("created_at").alias("event_date"),
        F.hour("created_at").alias("event_hour"),
    )


def totals(silver: DataFrame) -> DataFrame:
    """Row count beside distinct event ids; equal when no duplicate is left."""
    return silver.agg(
        F.count("*").alias("total_rows"), F.countDistinct("event_id").alias("distinct_event_ids")
    )


def type_breakdown(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type")


def hourly_event_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("event_date", "event_hour", "event_type").agg(F.count("*").alias("n"))
