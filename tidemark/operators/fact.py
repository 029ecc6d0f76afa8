"""Factless event fact: one row per event, keys only."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import date_key, surrogate_key
from tidemark.session import as_utc

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def fact_events(stg: DataFrame) -> DataFrame:
    """Keys are computed from the natural keys, so no dimension has to be looked up."""
    return stg.select(
        "event_id",
        surrogate_key("repo_id").alias("repo_sk"),
        surrogate_key("actor_id").alias("actor_sk"),
        date_key("event_date").alias("date_key"),
        "event_type",
        "event_date",
        "created_at",
    )


def watermark(fact: DataFrame) -> DataFrame:
    """Latest created_at, one row, NULL when the fact is empty.

    It lies in the newest event_date, so only that partition's timestamps are read.
    """
    newest = fact.agg(F.max("event_date")).scalar()
    return fact.where(F.col("event_date") == newest).agg(F.max("created_at").alias("watermark"))


def between(events: DataFrame, since: datetime | None, until: datetime | None) -> DataFrame:
    """Rows with since <= created_at < until. The same range on event_date prunes partitions."""
    if since is not None:
        since = as_utc(since)
        events = events.where(
            (F.col("event_date") >= F.lit(since.date())) & (F.col("created_at") >= F.lit(since))
        )
    if until is not None:
        until = as_utc(until)
        events = events.where(
            (F.col("event_date") <= F.lit(until.date())) & (F.col("created_at") < F.lit(until))
        )
    return events


def incremental_slice(
    events: DataFrame,
    fact: DataFrame,
    lookback: timedelta = timedelta(hours=1),
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """Events the fact may not hold yet.

    By default everything from ``lookback`` before the fact's watermark on, and everything when
    the fact is empty. An explicit range instead serves a backfill behind the watermark. The
    watermark is one value and is fetched, so that the range is known when the scan is planned.
    ``events`` is the silver table or a projection of it that keeps event_date and created_at.
    """
    if since is None and until is None:
        mark = watermark(fact).select(F.unix_micros("watermark")).first()[0]
        since = None if mark is None else _EPOCH + timedelta(microseconds=mark) - lookback
    return between(events, since, until)
