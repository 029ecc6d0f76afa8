"""Ranked daily marts over the fact table and its dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import default_unknown
from tidemark.operators.joins import HOT_SHARE, join_lookup
from tidemark.operators.ranking import with_daily_rank
from tidemark.schemas import CONTRIBUTION_TYPES, STAR_TYPE


def count_per_day(fact: DataFrame, entity: str, name: str) -> DataFrame:
    return fact.groupBy("date_key", entity).agg(F.count("*").alias(name))


def stars_per_repo_day(fact: DataFrame) -> DataFrame:
    return count_per_day(fact.where(F.col("event_type") == STAR_TYPE), "repo_sk", "stars")


def contributions_per_actor_day(
    fact: DataFrame, allowlist: Sequence[str] = CONTRIBUTION_TYPES
) -> DataFrame:
    return count_per_day(
        fact.where(F.col("event_type").isin(list(allowlist))), "actor_sk", "contributions"
    )


def repo_days(fact: DataFrame) -> DataFrame:
    """Events and stars per repository and day, which is all the repository marts need."""
    stars = F.count_if(F.col("event_type") == STAR_TYPE)
    return fact.groupBy("date_key", "repo_sk").agg(
        F.count("*").alias("events"), stars.alias("stars")
    )


# From daily counts to marts. Names come from the dimensions as they are now.


def name_stars(stars: DataFrame, dim_repo: DataFrame) -> DataFrame:
    return stars.join(dim_repo, "repo_sk").select(
        "date_key", "repo_sk", "repo_id", "repo_name", "stars"
    )


def rank_trending(stars: DataFrame, dim_repo: DataFrame) -> DataFrame:
    return with_daily_rank(name_stars(stars, dim_repo), "stars", "repo_sk")


def name_contributions(contributions: DataFrame, dim_actor: DataFrame) -> DataFrame:
    return contributions.join(dim_actor, "actor_sk").select(
        "date_key", "actor_sk", "actor_id", "actor_login", "contributions"
    )


def rank_contributors(contributions: DataFrame, dim_actor: DataFrame) -> DataFrame:
    return with_daily_rank(
        name_contributions(contributions, dim_actor), "contributions", "actor_sk"
    )


def repo_language(dim_repo: DataFrame, seed: DataFrame) -> DataFrame:
    """Language of every repository. The seed covers some; the others stay, as 'Unknown'."""
    return dim_repo.join(seed, "repo_id", "left").select(
        "repo_sk", default_unknown("language").alias("language")
    )


def count_languages(events: DataFrame, dim_repo: DataFrame, seed: DataFrame) -> DataFrame:
    """Events and active repositories per day and language.

    Nearly all events fall in 'Unknown'. ``events`` already has one row per repository and day,
    so what would be a distinct count over events is a plain count here.
    """
    return (
        events.join(repo_language(dim_repo, seed), "repo_sk")
        .groupBy("date_key", "language")
        .agg(F.sum("events").alias("event_count"), F.count("*").alias("active_repos"))
    )


def language_rank(counts: DataFrame) -> DataFrame:
    """Rank within the day. A day has one row per language here, so a plain window is small."""
    by_count = Window.partitionBy("date_key").orderBy(F.desc("event_count"))
    return counts.withColumn("daily_rank", F.rank().over(by_count).cast("bigint"))


def momentum_delta(counts: DataFrame) -> DataFrame:
    """Change against the language's previous day with events; NULL on its first one."""
    by_day = Window.partitionBy("language").orderBy("date_key")
    return counts.withColumn(
        "momentum_delta", F.col("event_count") - F.lag("event_count").over(by_day)
    )


def rank_languages(events: DataFrame, dim_repo: DataFrame, seed: DataFrame) -> DataFrame:
    return momentum_of(count_languages(events, dim_repo, seed))


def momentum_of(counts: DataFrame) -> DataFrame:
    """The mart from the counts of all days, one row for each language and day."""
    return language_rank(momentum_delta(counts)).select(
        "date_key", "language", "event_count", "active_repos", "momentum_delta", "daily_rank"
    )


# From the fact to marts


def trending_repos_daily(fact: DataFrame, dim_repo: DataFrame) -> DataFrame:
    return rank_trending(stars_per_repo_day(fact), dim_repo)


def contributor_leaderboard(
    fact: DataFrame, dim_actor: DataFrame, allowlist: Sequence[str] = CONTRIBUTION_TYPES
) -> DataFrame:
    return rank_contributors(contributions_per_actor_day(fact, allowlist), dim_actor)


def language_day_counts(fact: DataFrame, dim_repo: DataFrame, seed: DataFrame) -> DataFrame:
    return count_languages(count_per_day(fact, "repo_sk", "events"), dim_repo, seed)


def language_momentum(fact: DataFrame, dim_repo: DataFrame, seed: DataFrame) -> DataFrame:
    return rank_languages(count_per_day(fact, "repo_sk", "events"), dim_repo, seed)


def enrich_language(
    fact: DataFrame,
    dim_repo: DataFrame,
    seed: DataFrame,
    share: int = HOT_SHARE,
    repo_days: DataFrame | None = None,
) -> DataFrame:
    """Fact rows with their repository's language; drops and multiplies none. Stored ``repo_days`` tell the hot ones."""
    language = repo_language(dim_repo, seed)
    return join_lookup(fact, language, "repo_sk", share, repo_days, "events")
