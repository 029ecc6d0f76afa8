"""Dimensions of the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import date_key, parse_day, surrogate_key


def dim_event_type(stg: DataFrame) -> DataFrame:
    return stg.select("event_type").distinct()


def spellings(stg: DataFrame, key: str, attribute: str) -> DataFrame:
    """When each spelling of each key was last seen.

    A hash aggregate on a timestamp, so events are neither sorted nor shuffled whole.
    """
    return stg.groupBy(key, attribute).agg(F.max("created_at").alias("last_seen"))


def merge_spellings(known: DataFrame, new: DataFrame, key: str, attribute: str) -> DataFrame:
    """Bring stored spellings up to date; merging the same events again changes nothing."""
    both = known.unionByName(new)
    return both.groupBy(key, attribute).agg(F.max("last_seen").alias("last_seen"))


def latest_by(seen: DataFrame, key: str, attribute: str, key_name: str) -> DataFrame:
    """One row per key with the spelling seen last; of two seen in one instant, the greater."""
    order = F.struct("last_seen", attribute)
    latest = seen.groupBy(key).agg(F.max_by(attribute, order).alias(attribute))
    return latest.select(surrogate_key(key).alias(key_name), key, attribute)


def dim_repo_from(seen: DataFrame) -> DataFrame:
    return latest_by(seen, "repo_id", "repo_name", "repo_sk")


def dim_actor_from(seen: DataFrame) -> DataFrame:
    return latest_by(seen, "actor_id", "actor_login", "actor_sk")


def dim_repo(stg: DataFrame) -> DataFrame:
    return dim_repo_from(spellings(stg, "repo_id", "repo_name"))


def dim_actor(stg: DataFrame) -> DataFrame:
    """Public id and login only; no other identity column exists from silver on."""
    return dim_actor_from(spellings(stg, "actor_id", "actor_login"))


def _calendar(days: DataFrame, day: str) -> DataFrame:
    d: Column = F.col(day)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month"),
        F.dayofmonth(d).cast("bigint").alias("day"),
        F.dayofweek(d).cast("bigint").alias("day_of_week"),  # 1 = Sunday
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_date(
    spark: SparkSession,
    start: str | date = "2024-01-01",
    end_exclusive: str | date = "2025-01-01",
) -> DataFrame:
    """Gap-free calendar, independent of which days have events."""
    first, last = parse_day(start), parse_day(end_exclusive)
    if last <= first:
        raise ValueError("end_exclusive must be after start")
    days = spark.range((last - first).days).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("d")
    )
    return _calendar(days, "d")


def dim_date_for(stg: DataFrame) -> DataFrame:
    """Calendar over every whole year that has events, so that no event day is an orphan."""
    bounds = stg.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    first = F.trunc("lo", "year")
    last = F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)
    return _calendar(bounds.select(F.explode(F.sequence(first, last)).alias("d")), "d")
