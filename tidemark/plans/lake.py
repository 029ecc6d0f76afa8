"""Where everything lies under one root folder."""

from __future__ import annotations

from dataclasses import dataclass

from tidemark.sources.silver import SilverPaths


@dataclass(frozen=True)
class Lake:
    """The calendar is declared, not derived: an event outside it fails the fact's date check."""

    root: str
    calendar_start: str = "2024-01-01"
    calendar_end: str = "2025-01-01"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> SilverPaths:
        base = f"{self.root}/silver"
        return SilverPaths(f"{base}/events", f"{base}/quarantine", f"{base}/late")

    @property
    def silver_events(self) -> str:
        """The warehouse table the star schema reads."""
        return f"{self.root}/warehouse/silver_events"

    @property
    def id_bitmaps(self) -> str:
        """Distinct ids of every loaded hour, in a form that can be merged."""
        return f"{self.root}/warehouse/id_bitmaps"

    @property
    def seed(self) -> str:
        return f"{self.root}/seeds/repo_languages"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    @property
    def partitioned(self) -> dict[str, int]:
        """Tables whose partitions are swapped, with the number of their partition columns."""
        tables = {self.silver.events: 2, self.silver.quarantine: 2, self.silver.late: 3, self.silver_events: 2, self.id_bitmaps: 2}
        by_one = [
            "fact_events",
            "fact_events_ids",
            "repo_spellings",
            "actor_spellings",
            "dim_repo",
            "dim_actor",
            "repo_days",
            "actor_days",
            "language_days",
            "trending_repos_daily",
            "contributor_leaderboard",
            "language_momentum",
        ]
        return {**tables, **{self.gold(name): 1 for name in by_one}, self.runs: 1}

    @property
    def summaries(self) -> str:
        return f"{self.root}/ops/run_summaries"

    @property
    def runs(self) -> str:
        return f"{self.root}/ops/pipeline_run_metadata"
