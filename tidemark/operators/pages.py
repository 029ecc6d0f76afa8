"""Stable pages over the marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import day_to_date_key, parse_day

MAX_LIMIT = 100


def on_day(table: DataFrame, day: str | date) -> DataFrame:
    """Rows of one day. A table partitioned by event_date gets that predicate too, to prune."""
    rows = table.where(F.col("date_key") == F.lit(day_to_date_key(day)))
    if "event_date" in table.columns:
        rows = rows.where(F.col("event_date") == F.lit(parse_day(day)))
    return rows


def page(
    mart: DataFrame,
    day: str | date,
    limit: int,
    offset: int,
    tie_break: str,
    max_offset: int,
    columns: Sequence[str],
) -> DataFrame:
    """Rows of one day by rank, ties by ``tie_break`` descending, which is unique in a day.

    Bad arguments raise before Spark is touched. The row at position p never ranks below p, so
    a filter on the rank lets Parquet skip what cannot be on the page.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be 1..{MAX_LIMIT}, got {limit}")
    if not 0 <= offset <= max_offset:
        raise ValueError(f"offset must be 0..{max_offset}, got {offset}")
    return (
        on_day(mart, day)
        .where(F.col("daily_rank") <= offset + limit)
        .select(*columns)
        .orderBy(F.asc("daily_rank"), F.desc(tie_break))
        .offset(offset)
        .limit(limit)
    )


def trending_page(mart: DataFrame, day: str | date, limit: int = 50, offset: int = 0) -> DataFrame:
    columns = ["date_key", "repo_id", "repo_name", "stars", "daily_rank"]
    return page(mart, day, limit, offset, "repo_id", 10_000, columns)


def momentum_page(mart: DataFrame, day: str | date, limit: int = 50, offset: int = 0) -> DataFrame:
    columns = [
        "date_key",
        "language",
        "event_count",
        "active_repos",
        "momentum_delta",
        "daily_rank",
    ]
    return page(mart, day, limit, offset, "language", 100_000, columns)


def leaderboard_page(
    mart: DataFrame, day: str | date, limit: int = 50, offset: int = 0
) -> DataFrame:
    columns = ["date_key", "actor_id", "actor_login", "contributions", "daily_rank"]
    return page(mart, day, limit, offset, "actor_id", 50_000, columns)
