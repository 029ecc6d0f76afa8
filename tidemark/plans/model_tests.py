"""Tests each model must pass before anything is built on it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.schemas import EVENT_TYPES


class ModelTestError(Exception):
    """A model broke one of its tests; what depends on it must not be built."""


@dataclass(frozen=True)
class ModelTests:
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_combination: Sequence[str] = ()
    accepted_values: dict[str, Sequence[str]] = field(default_factory=dict)
    accepted_range: dict[str, tuple[int, int]] = field(default_factory=dict)
    relationships: dict[str, str] = field(default_factory=dict)  # key column -> parent model


MODEL_TESTS = {
    "stg_events": ModelTests(
        not_null=["event_id", "event_type", "created_at"], unique=["event_id"]
    ),
    "repo_languages": ModelTests(not_null=["repo_id", "language"], unique=["repo_id"]),
    "dim_event_type": ModelTests(
        not_null=["event_type"],
        unique=["event_type"],
        accepted_values={"event_type": EVENT_TYPES},
    ),
    "dim_repo": ModelTests(
        not_null=["repo_sk", "repo_id", "repo_name"], unique=["repo_sk", "repo_id"]
    ),
    "dim_actor": ModelTests(
        not_null=["actor_sk", "actor_id", "actor_login"], unique=["actor_sk", "actor_id"]
    ),
    "dim_date": ModelTests(
        not_null=["date_key", "full_date"],
        unique=["date_key", "full_date"],
        accepted_range={"month": (1, 12), "day_of_week": (1, 7)},
    ),
    "fact_events": ModelTests(
        not_null=["event_id", "repo_sk", "actor_sk", "date_key", "event_type"],
        unique=["event_id"],
        relationships={
            "repo_sk": "dim_repo",
            "actor_sk": "dim_actor",
            "date_key": "dim_date",
            "event_type": "dim_event_type",
        },
    ),
    "trending_repos_daily": ModelTests(
        not_null=["date_key", "repo_sk", "repo_name", "stars", "daily_rank"],
        unique_combination=["date_key", "repo_sk"],
        relationships={"date_key": "dim_date", "repo_sk": "dim_repo"},
    ),
    "language_momentum": ModelTests(
        not_null=["date_key", "language", "event_count", "active_repos", "daily_rank"],
        unique_combination=["date_key", "language"],
        relationships={"date_key": "dim_date"},
    ),
    "contributor_leaderboard": ModelTests(
        not_null=["date_key", "actor_sk", "actor_login", "contributions", "daily_rank"],
        unique_combination=["date_key", "actor_sk"],
        relationships={"date_key": "dim_date", "actor_sk": "dim_actor"},
    ),
}


def results_of(
    name: str, model: DataFrame, parent: Callable[[str], DataFrame] | None = None
) -> DataFrame:
    """One row per test of the model: (model, test, column_name, failures).

    All NULL counts come from one scan and all foreign keys from another. ``parent`` gives the
    frame of a model by its name.
    """
    tests = MODEL_TESTS[name]
    parts = [
        quality.not_null(model, tests.not_null).select(
            F.lit("not_null").alias("test"), "column_name", "failures"
        )
    ]

    def counted(test: str, column: str, failing: DataFrame) -> None:
        parts.append(
            failing.agg(
                F.lit(test).alias("test"),
                F.lit(column).alias("column_name"),
                F.count("*").alias("failures"),
            )
        )

    for column in tests.unique:
        counted("unique", column, quality.unique(model, column))
    if tests.unique_combination:
        columns = tests.unique_combination
        failing = quality.unique_combination(model, columns)
        counted("unique_combination", ",".join(columns), failing)
    for column, values in tests.accepted_values.items():
        counted("accepted_values", column, quality.accepted_values(model, column, values))
    for column, (low, high) in tests.accepted_range.items():
        counted("accepted_range", column, quality.accepted_range(model, column, low, high))
    if tests.relationships:
        orphans = quality.orphan_keys(
            model, {fk: parent(of) for fk, of in tests.relationships.items()}
        )
        per_key = orphans.agg(
            *[F.count_if(F.col("fk") == fk).alias(fk) for fk in tests.relationships]
        ).unpivot([], list(tests.relationships), "column_name", "failures")
        parts.append(
            per_key.select(F.lit("relationships").alias("test"), "column_name", "failures")
        )
    return quality.stack(parts).select(F.lit(name).alias("model"), "*")


def require_passing(
    models: dict[str, DataFrame], parent: Callable[[str], DataFrame] | None = None
) -> None:
    """Raise if any test of any of the models fails; all of them run as one job."""
    results = quality.stack([results_of(name, df, parent) for name, df in models.items()])
    failed = results.where("failures > 0").collect()
    if failed:
        found = "; ".join(f"{r.model} {r.test}({r.column_name}): {r.failures}" for r in failed)
        raise ModelTestError(found)
