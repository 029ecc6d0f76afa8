"""One query per operator over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hours import as_hour
from tidemark.functions.keys import (
    bronze_partition_path,
    date_key,
    day_to_date_key,
    default_unknown,
    hour_key,
    silver_partition_path,
    surrogate_key,
)
from tidemark.operators import bitmaps, dims, fact, marts, pages, quality, run_json, runs, silver
from tidemark.plans import fixture
from tidemark.plans.model_tests import results_of
from tidemark.schemas import CONTRIBUTION_TYPES, EVENT_TYPES, SILVER_COLUMNS, SILVER_REQUIRED
from tidemark.session import scratch_path, use_utc, written_once
from tidemark.sources import bronze as bronze_io
from tidemark.sources import fact as fact_io
from tidemark.sources import runs as runs_io
from tidemark.sources import silver as silver_io
from tidemark.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-17"
HOUR = 12
CUTOVER = datetime(2024, 1, 20)
AS_OF = datetime(2024, 1, 31, 6)
RECORDED_AT = datetime(2024, 2, 1)
# The given tables hold a handful of events per hour, with one in fifty repeated; a quiet hour fails.
BOUNDS = quality.SuiteBounds(min_rows=2, max_rows=900_000, residual_threshold=0.1)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only keeps modules apart."""

    @wraps(fn)
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = in_utc
    return fn


class Star:
    """The star schema as lazy frames over one staging frame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.stg = fixture.staging(spark, sf_dir)
        self.fact = fact.fact_events(self.stg)
        self.repo = dims.dim_repo(self.stg)
        self.actor = dims.dim_actor(self.stg)
        self.seed = fixture.seed(self.stg)

    def trending(self) -> DataFrame:
        return marts.trending_repos_daily(self.fact, self.repo)

    def momentum(self) -> DataFrame:
        return marts.language_momentum(self.fact, self.repo, self.seed)

    def leaderboard(self) -> DataFrame:
        return marts.contributor_leaderboard(self.fact, self.actor)


class StoredStar:
    """The same star schema from stored tables, written at their first use, as a refresh leaves them.

    Checks read it: each of them then scans a small table instead of building it from the events anew.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._star = Star(spark, sf_dir)
        self.stg = self._star.stg
        self.fact = self._table("fact", ["event_date"], ["event_type"])
        self.repo, self.actor, self.seed = self._table("repo"), self._table("actor"), self._table("seed")

    def _table(self, name: str, columns: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
        rows = getattr(self._star, name)

        def write(path: str) -> None:
            tables.replace_table(rows, path, columns, sort_by)

        path = written_once(self._spark, f"star-{name}", self._sf_dir, write)
        return tables.read_table(self._spark, path, rows.schema).select(*rows.columns)

    def repo_days(self) -> DataFrame:
        """Events of every repository and day."""

        def write(path: str) -> None:
            tables.replace_table(marts.repo_days(self._star.fact), path, ["date_key"])

        return tables.read_mart(self._spark, written_once(self._spark, "star-repo-days", self._sf_dir, write))

    def trending(self) -> DataFrame:
        return _mart_table(self._spark, self._sf_dir, "trending")

    def momentum(self) -> DataFrame:
        return _mart_table(self._spark, self._sf_dir, "momentum")

    def leaderboard(self) -> DataFrame:
        return _mart_table(self._spark, self._sf_dir, "leaderboard")


def _dirty_flat(spark, sf_dir) -> DataFrame:
    return silver.flatten(fixture.raw_events(spark, sf_dir, dirty=True))


def _dirty_silver(spark, sf_dir) -> DataFrame:
    return silver.transform_events(fixture.raw_events(spark, sf_dir, dirty=True))


def _gate_inputs(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw, valid silver, quarantined) of the dirty events."""
    raw = fixture.raw_events(spark, sf_dir, dirty=True)
    valid, bad = silver.split_quarantine(silver.transform_events(raw))
    return raw, valid.drop("source_date", "source_hour"), bad


def _verdict(spark, sf_dir, scope: str = "hour") -> DataFrame:
    raw, valid, bad = _gate_inputs(spark, sf_dir)
    return quality.suite_verdict(raw, valid, bad, RECORDED_AT, BOUNDS, scope)


def _written_silver(spark, sf_dir) -> str:
    """All hour files as one silver table."""

    def write(root: str) -> None:
        raw = bronze_io.read_bronze(spark, fixture.landed_bronze(spark, sf_dir))
        silver_io.write_silver(silver.transform_events(raw), root)

    return written_once(spark, "silver", sf_dir, write)


def _mart_table(spark, sf_dir, name: str) -> DataFrame:
    """A mart as a stored table: computed once, served often."""

    def write(path: str) -> None:
        mart = getattr(Star(spark, sf_dir), name)()
        tables.replace_table(mart, path, ["date_key"], ["daily_rank"])

    return tables.read_mart(spark, written_once(spark, name, sf_dir, write))


# Scans and sources


@query
def bronze_json_scan(spark, sf_dir):
    raw = bronze_io.read_bronze(spark, fixture.landed_bronze(spark, sf_dir))
    return silver.flatten(raw)


@query
def bronze_line_count(spark, sf_dir):
    root = fixture.landed_bronze(spark, sf_dir)
    return bronze_io.count_lines(bronze_io.read_bronze_lines(spark, root))


@query
def silver_hour_slice(spark, sf_dir):
    return silver_io.read_silver_hour(spark, _written_silver(spark, sf_dir), DAY, HOUR)


@query
def quarantine_scan(spark, sf_dir):
    return silver_io.read_quarantine(spark, _written_silver(spark, sf_dir))


@query
def seed_scan(spark, sf_dir):
    return fixture.seed_file(spark, sf_dir)


@query
def run_metadata_scan(spark, sf_dir):
    path = scratch_path(spark, "runs")
    runs_io.append_runs(_run_rows(spark, sf_dir), path)
    return runs_io.read_runs(spark, path).select(
        "run_id",
        "recorded_at",
        "logical_date",
        *runs.RUN_COUNTS,
        F.size("tasks").alias("task_count"),
        runs.run_verdict().alias("verdict"),
    )


@query
def stg_events(spark, sf_dir):
    return fixture.staging(spark, sf_dir)


@query
def silver_partition_path_(spark, sf_dir):
    hours = fixture.staging(spark, sf_dir).groupBy("event_date", "event_hour")
    day, hour = F.col("event_date"), F.col("event_hour")
    return hours.agg(F.count("*").alias("n")).select(
        bronze_partition_path(day, hour).alias("bronze_path"),
        silver_partition_path(day, hour).alias("silver_path"),
        hour_key(day, hour).alias("table_partition"),
        "n",
    )


# Sinks


@query
def bronze_land(spark, sf_dir):
    """Landing again skips the hours that are there."""
    root = scratch_path(spark, "bronze")
    lines = fixture.raw_lines(spark, sf_dir)
    bronze_io.land_bronze(lines, root)
    bronze_io.land_bronze(lines, root)
    return bronze_io.count_lines(bronze_io.read_bronze_lines(spark, root))


@query
def silver_partition_overwrite(spark, sf_dir):
    """All hour files to silver, then one of them again, which changes nothing."""
    root = scratch_path(spark, "silver")
    paths = silver_io.SilverPaths(f"{root}/events", f"{root}/quarantine", f"{root}/late")
    raw = bronze_io.read_bronze(spark, fixture.landed_bronze(spark, sf_dir))
    hours = [
        (r.source_date, r.source_hour)
        for r in raw.select("source_date", "source_hour").distinct().collect()
    ]
    silver_io.write_silver_hours(silver.transform_events(raw), paths, hours)
    again = [as_hour(DAY, HOUR)]
    raw = bronze_io.read_bronze(spark, fixture.landed_bronze(spark, sf_dir), again)
    silver_io.write_silver_hours(silver.transform_events(raw), paths, again)
    return silver_io.read_silver(spark, paths.events)


@query
def silver_load_hour(spark, sf_dir):
    table = scratch_path(spark, "silver_events")
    valid, _ = silver.split_quarantine(_dirty_silver(spark, sf_dir))
    distinct = valid.select("event_date", "event_hour").distinct()
    hours = [(r.event_date, r.event_hour) for r in distinct.collect()]
    silver_io.load_hours(valid, table, hours)
    return silver_io.read_silver(spark, table)


def _upserted_fact(spark, sf_dir) -> str:
    """A fact that stops at the cutover, brought up to date from its watermark."""
    path = scratch_path(spark, "fact")
    stg = fixture.staging(spark, sf_dir)
    fact_io.write_fact(
        spark, path, fact.fact_events(fact.between(stg, None, CUTOVER)), full_refresh=True
    )
    fresh = fact.incremental_slice(stg, fact_io.read_fact(spark, path))
    fact_io.write_fact(spark, path, fact.fact_events(fresh))
    return path


@query
def fact_upsert(spark, sf_dir):
    return fact_io.read_fact(spark, _upserted_fact(spark, sf_dir))


@query
def mart_table_sink(spark, sf_dir):
    return _mart_table(spark, sf_dir, "trending")


@query
def run_metadata_append(spark, sf_dir):
    """Two appends, the second with the runs of the second half; readers see all rows."""
    path = scratch_path(spark, "runs")
    rows = _run_rows(spark, sf_dir)
    runs_io.append_runs(rows.where(F.col("logical_date") < F.lit(CUTOVER)), path)
    runs_io.append_runs(rows.where(F.col("logical_date") >= F.lit(CUTOVER)), path)
    return _exploded_tasks(runs_io.read_runs(spark, path))


@query
def fact_cluster_layout(spark, sf_dir):
    path = scratch_path(spark, "fact")
    fact_io.write_fact(
        spark, path, fact.fact_events(fixture.staging(spark, sf_dir)), full_refresh=True
    )
    return (
        fact_io.read_fact(spark, path)
        .groupBy("event_date", "event_type")
        .agg(F.count("*").alias("n"), F.max("created_at").alias("last_seen"))
    )


# Projections, filters, predicates


@query
def silver_flatten(spark, sf_dir):
    return _dirty_flat(spark, sf_dir)


@query
def silver_typed(spark, sf_dir):
    return silver.typed(_dirty_flat(spark, sf_dir))


@query
def silver_partition_columns(spark, sf_dir):
    return silver.partition_columns(silver.typed(_dirty_flat(spark, sf_dir)))


@query
def silver_quarantine_split(spark, sf_dir):
    """Both halves, counted by hour file from one pass."""
    tagged = silver.row_kind(_dirty_silver(spark, sf_dir))
    return tagged.groupBy("source_date", "source_hour").agg(
        F.count_if(F.col("row_kind") != "bad").alias("valid_rows"),
        F.count_if(F.col("row_kind") == "bad").alias("quarantine_rows"),
    )


@query
def column_allowlist(spark, sf_dir):
    """Only the declared columns survive from bronze, whatever else the lines hold."""
    raw = bronze_io.read_bronze(spark, fixture.landed_bronze(spark, sf_dir))
    return silver.flatten(raw).select(*SILVER_COLUMNS)


@query
def filter_event_type(spark, sf_dir):
    star = Star(spark, sf_dir)
    return star.fact.where(F.col("event_type") == marts.STAR_TYPE)


@query
def filter_contribution_types(spark, sf_dir):
    star = Star(spark, sf_dir)
    return star.fact.where(F.col("event_type").isin(CONTRIBUTION_TYPES))


@query
def fact_watermark_filter(spark, sf_dir):
    stg = fixture.staging(spark, sf_dir)
    loaded = fact.fact_events(fact.between(stg, None, CUTOVER))
    return fact.incremental_slice(stg, loaded)


@query
def filter_date_key(spark, sf_dir):
    return pages.on_day(Star(spark, sf_dir).fact, DAY)


@query
def default_unknown_(spark, sf_dir):
    star = Star(spark, sf_dir)
    return star.repo.join(star.seed, "repo_id", "left").select(
        "repo_id", default_unknown("language").alias("language")
    )


# Joins


@query
def join_fact_dim_repo(spark, sf_dir):
    star = Star(spark, sf_dir)
    return marts.name_stars(marts.stars_per_repo_day(star.fact), star.repo)


@query
def join_fact_dim_actor(spark, sf_dir):
    star = Star(spark, sf_dir)
    return marts.name_contributions(marts.contributions_per_actor_day(star.fact), star.actor)


@query
def language_enrichment(spark, sf_dir):
    star = StoredStar(spark, sf_dir)
    # about half of the given repositories hold more than this share of the events
    enriched = marts.enrich_language(star.fact, star.repo, star.seed, 100, star.repo_days())
    return enriched.select("event_id", "date_key", "repo_sk", "language")


@query
def dq_relationships(spark, sf_dir):
    """Foreign keys of the fact and the marts against dimensions that lack some of their rows."""
    star = StoredStar(spark, sf_dir)
    old = fact.between(star.fact, None, CUTOVER)
    parents = {
        "repo_sk": star.repo.where("repo_id % 7 <> 3"),
        "actor_sk": star.actor.where("actor_id % 7 <> 3"),
        "date_key": old.select("date_key").distinct(),
        "event_type": dims.dim_event_type(star.fact).where("event_type <> 'ForkEvent'"),
    }
    children = {
        "fact_events": (star.fact, ["repo_sk", "actor_sk", "date_key", "event_type"]),
        "trending_repos_daily": (star.trending(), ["repo_sk", "date_key"]),
        "language_momentum": (star.momentum(), ["date_key"]),
        "contributor_leaderboard": (star.leaderboard(), ["actor_sk", "date_key"]),
    }
    orphans = [
        quality.orphan_keys(child, {fk: parents[fk] for fk in fks}).select(
            F.lit(name).alias("child"), "fk", "value", "n"
        )
        for name, (child, fks) in children.items()
    ]
    return quality.stack(orphans)


# Aggregations and distinct


@query
def silver_dedupe(spark, sf_dir):
    typed = silver.typed(_dirty_flat(spark, sf_dir))
    return silver.dedupe(silver.partition_columns(typed))


@query
def silver_totals(spark, sf_dir):
    return silver.totals(_dirty_flat(spark, sf_dir))


def _stored_bitmaps(spark, sf_dir) -> DataFrame:
    """Id bitmaps of every hour, as the load keeps them."""

    def write(path: str) -> None:
        raw = bronze_io.read_bronze(spark, fixture.landed_bronze(spark, sf_dir))
        valid, _ = silver.split_quarantine(silver.transform_events(raw))
        silver_io.write_bitmaps(valid, path)

    return silver_io.read_bitmaps(spark, written_once(spark, "id-bitmaps", sf_dir, write))


@query
def silver_totals_from_bitmaps(spark, sf_dir):
    """Totals of every day and of the whole table, from stored bitmaps; no event is read."""
    stored = _stored_bitmaps(spark, sf_dir)
    by_day = bitmaps.distinct_ids(stored, ["event_date"])
    whole = bitmaps.distinct_ids(stored).withColumn("event_date", F.lit(None).cast("date"))
    return by_day.unionByName(whole)


@query
def silver_type_breakdown(spark, sf_dir):
    return silver.type_breakdown(_dirty_silver(spark, sf_dir))


@query
def dim_event_type(spark, sf_dir):
    return dims.dim_event_type(fixture.staging(spark, sf_dir))


@query
def stars_per_repo_day(spark, sf_dir):
    return marts.stars_per_repo_day(Star(spark, sf_dir).fact)


@query
def contributions_per_actor_day(spark, sf_dir):
    return marts.contributions_per_actor_day(Star(spark, sf_dir).fact)


@query
def language_day_counts(spark, sf_dir):
    star = Star(spark, sf_dir)
    return marts.language_day_counts(star.fact, star.repo, star.seed)


@query
def fact_watermark(spark, sf_dir):
    return fact.watermark(Star(spark, sf_dir).fact)


@query
def hourly_event_counts(spark, sf_dir):
    return silver.hourly_event_counts(_dirty_silver(spark, sf_dir))


# Dimensions, fact, marts


@query
def dim_repo(spark, sf_dir):
    return Star(spark, sf_dir).repo


@query
def dim_actor(spark, sf_dir):
    return Star(spark, sf_dir).actor


@query
def dim_date(spark, sf_dir):
    """The declared calendar, independent of the events, with their number on each day."""
    calendar = dims.dim_date(spark)
    per_day = Star(spark, sf_dir).fact.groupBy("date_key").agg(F.count("*").alias("n"))
    joined = calendar.join(per_day, "date_key", "left")
    return joined.select(*calendar.columns, F.coalesce("n", F.lit(0)).alias("events"))


@query
def fact_events(spark, sf_dir):
    return Star(spark, sf_dir).fact


@query
def trending_repos_daily(spark, sf_dir):
    return Star(spark, sf_dir).trending()


@query
def contributor_leaderboard(spark, sf_dir):
    return Star(spark, sf_dir).leaderboard()


@query
def language_rank(spark, sf_dir):
    star = Star(spark, sf_dir)
    return marts.language_rank(marts.language_day_counts(star.fact, star.repo, star.seed))


@query
def language_momentum(spark, sf_dir):
    return Star(spark, sf_dir).momentum()


# Pages


@query
def serve_trending_page(spark, sf_dir):
    return pages.trending_page(_mart_table(spark, sf_dir, "trending"), DAY, limit=20, offset=5)


@query
def serve_momentum_page(spark, sf_dir):
    return pages.momentum_page(_mart_table(spark, sf_dir, "momentum"), DAY, limit=3, offset=1)


@query
def serve_leaderboard_page(spark, sf_dir):
    return pages.leaderboard_page(_mart_table(spark, sf_dir, "leaderboard"), DAY, limit=20, offset=10)


# Scalar functions


@query
def surrogate_key_(spark, sf_dir):
    stg = fixture.staging(spark, sf_dir)
    missing = F.when(F.col("event_type") != "ForkEvent", F.col("repo_id"))
    return stg.select(
        "event_id",
        surrogate_key("repo_id").alias("repo_sk"),
        surrogate_key(missing).alias("null_repo_sk"),
        surrogate_key("repo_id", "actor_id").alias("pair_sk"),
    )


@query
def smart_date_key(spark, sf_dir):
    stg = fixture.staging(spark, sf_dir)
    return stg.select("event_id", date_key("event_date").alias("date_key"))


@query
def day_to_date_key_(spark, sf_dir):
    stars = marts.stars_per_repo_day(Star(spark, sf_dir).fact)
    return stars.where(F.col("date_key") >= day_to_date_key(date(2024, 1, 17)))


def _summaries(spark, sf_dir) -> DataFrame:
    return fixture.summary_times(_verdict(spark, sf_dir))


def _run_rows(spark, sf_dir, tasks=fixture.tasks) -> DataFrame:
    stg = fixture.staging(spark, sf_dir)
    return runs.run_rows(fixture.runs(stg), tasks(stg), _summaries(spark, sf_dir))


def _exploded_tasks(meta: DataFrame) -> DataFrame:
    """One row per run and task, for comparing array contents."""
    return meta.select(
        "run_id",
        "recorded_at",
        "logical_date",
        *runs.RUN_COUNTS,
        F.posexplode("tasks").alias("pos", "task"),
    ).select("*", "task.task_id", "task.state", "task.duration").drop("task")


@query
def run_summary_verdict(spark, sf_dir):
    meta = _run_rows(spark, sf_dir)
    return meta.select("run_id", runs.run_verdict().alias("verdict"))


@query
def run_tasks_array(spark, sf_dir):
    arrays = runs.run_tasks(fixture.tasks(fixture.staging(spark, sf_dir)))
    return arrays.select("run_id", F.posexplode("tasks").alias("pos", "task")).select(
        "run_id", "pos", "task.task_id", "task.state", "task.duration"
    )


@query
def residual(spark, sf_dir):
    metrics = quality.hour_metrics(*_gate_inputs(spark, sf_dir))
    rest = quality.compute_residual(
        F.col("raw_rows"), F.col("hour_rows"), F.col("quarantine_rows")
    )
    return metrics.select("partition_date", "partition_hour", rest.alias("residual_rows"))


@query
def residual_ok(spark, sf_dir):
    metrics = quality.hour_metrics(*_gate_inputs(spark, sf_dir))
    rest = quality.compute_residual(
        F.col("raw_rows"), F.col("hour_rows"), F.col("quarantine_rows")
    )
    ok = quality.residual_ok(rest, F.col("raw_rows"), 0.1)
    return metrics.select("partition_date", "partition_hour", ok.alias("residual_check"))


# Data quality


@query
def dq_not_null(spark, sf_dir):
    """The dirty rows before the quarantine split: only the broken timestamps are NULL."""
    return quality.not_null(_dirty_silver(spark, sf_dir), [*SILVER_COLUMNS, "event_date"])


@query
def dq_unique(spark, sf_dir):
    return quality.unique(_dirty_flat(spark, sf_dir), "event_id")


@query
def dq_accepted_values(spark, sf_dir):
    """The table's own activity names are outside the event-type domain, all of them."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    renamed = fixture.staging(spark, sf_dir).select("event_type")
    both = events.select("event_type").unionByName(renamed)
    return quality.accepted_values(both, "event_type", EVENT_TYPES)


@query
def dq_accepted_range(spark, sf_dir):
    """Calendar parts of every event, of which weekends fall outside the narrower range."""
    stg = fixture.staging(spark, sf_dir)
    parts = stg.select(
        "event_id",
        F.month("event_date").cast("bigint").alias("month"),
        F.dayofweek("event_date").cast("bigint").alias("day_of_week"),
    )
    checks = [("month", 1, 12), ("day_of_week", 1, 7), ("day_of_week", 2, 6)]
    return quality.stack(
        [
            quality.accepted_range(parts, column, low, high).agg(
                F.lit(f"{column} {low}..{high}").alias("check_name"),
                F.count("*").alias("failures"),
            )
            for column, low, high in checks
        ]
    )


@query
def dq_unique_combination(spark, sf_dir):
    """Grain guards: the marts hold; the events behind them repeat (day, repository)."""
    star = StoredStar(spark, sf_dir)
    grains = {
        "trending_repos_daily": (star.trending(), ["date_key", "repo_sk"]),
        "language_momentum": (star.momentum(), ["date_key", "language"]),
        "contributor_leaderboard": (star.leaderboard(), ["date_key", "actor_sk"]),
        "fact_events": (star.fact, ["date_key", "repo_sk"]),
    }
    return quality.stack(
        [
            quality.unique_combination(df, columns).agg(
                F.lit(name).alias("table_name"), F.count("*").alias("failures")
            )
            for name, (df, columns) in grains.items()
        ]
    )


@query
def dq_model_tests(spark, sf_dir):
    """Every test declared on the seed, the staging view, the star schema and the marts.

    Staging and fact come from the dirty events, and the seed and the dimensions have a row too many or
    too few, so that every kind of test has something to find.
    """
    star = StoredStar(spark, sf_dir)
    dirty = silver.stg_events(silver.typed(_dirty_flat(spark, sf_dir)))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type")
    models = {
        "stg_events": dirty,
        "repo_languages": star.seed.unionByName(star.seed.where("repo_id % 5 = 0")),
        "dim_event_type": dims.dim_event_type(events.unionByName(star.stg.select("event_type"))),
        "dim_repo": star.repo.where("repo_id % 7 <> 3"),
        "dim_actor": star.actor.where("actor_id % 7 <> 3"),
        "dim_date": dims.dim_date(spark, "2024-01-01", "2024-01-20"),
        "fact_events": fact.fact_events(dirty),
        "trending_repos_daily": star.trending(),
        "language_momentum": star.momentum(),
        "contributor_leaderboard": star.leaderboard(),
    }
    return quality.stack([results_of(n, df, models.__getitem__) for n, df in models.items()])


@query
def dq_source_freshness(spark, sf_dir):
    return quality.freshness(fixture.staging(spark, sf_dir), "created_at", AS_OF)


@query
def dq_columns_match_set(spark, sf_dir):
    """Silver still carries its partition columns here, so the set does not match."""
    return quality.columns_match_set(fixture.staging(spark, sf_dir), SILVER_COLUMNS)


@query
def dq_null_rate_mostly(spark, sf_dir):
    return quality.null_rate(
        _dirty_silver(spark, sf_dir), ["actor_id", "repo_id", "created_at"]
    )


@query
def dq_contract_not_null(spark, sf_dir):
    valid, _ = silver.split_quarantine(_dirty_silver(spark, sf_dir))
    return quality.not_null(valid, SILVER_REQUIRED)


@query
def dq_event_id_unique(spark, sf_dir):
    return quality.values_unique(_dirty_flat(spark, sf_dir), "event_id")


@query
def dq_row_count_between(spark, sf_dir):
    return quality.row_count_between(_dirty_silver(spark, sf_dir))


@query
def dq_quarantine_zero(spark, sf_dir):
    _, bad = silver.split_quarantine(_dirty_silver(spark, sf_dir))
    return quality.quarantine_zero(bad)


@query
def dq_residual(spark, sf_dir):
    return quality.residual(*_gate_inputs(spark, sf_dir))


@query
def dq_suite_verdict(spark, sf_dir):
    return _verdict(spark, sf_dir)


@query
def dq_suite_verdict_table_scope(spark, sf_dir):
    return _verdict(spark, sf_dir, "table")


@query
def dq_gate(spark, sf_dir):
    """The hours the gate stops, and the check that stops each."""
    return quality.blocked_hours(_verdict(spark, sf_dir)).select(
        "partition_date",
        "partition_hour",
        "quarantine_check",
        "residual_check",
        "great_expectations_suite_check",
    )


@query
def mart_reconciliation(spark, sf_dir):
    star = StoredStar(spark, sf_dir)
    return quality.mart_reconciliation(
        star.fact, star.repo, star.trending(), star.momentum(), star.leaderboard()
    )


# Run metadata


@query
def run_metadata_row(spark, sf_dir):
    return _exploded_tasks(_run_rows(spark, sf_dir))


@query
def run_summary_freshness(spark, sf_dir):
    stg = fixture.staging(spark, sf_dir)
    fresh = runs.fresh_summaries(fixture.runs(stg), _summaries(spark, sf_dir))
    return fresh.select(
        "run_id",
        F.col("summary").isNotNull().alias("is_fresh"),
        F.col("summary.hour_rows").alias("hour_rows"),
    )


def _run_table(spark, sf_dir) -> str:
    """The run table, written at its first use and read often, as one that runs append to."""

    def write(path: str) -> None:
        runs_io.append_runs(_run_rows(spark, sf_dir, fixture.nameless_tasks), path)

    return written_once(spark, "run-table", sf_dir, write)


@query
def run_history(spark, sf_dir):
    """The newest days of the run table, as many as the limit needs."""
    history = runs_io.recent_runs(spark, _run_table(spark, sf_dir), limit=100)
    return history.select(
        "run_id",
        "logical_date",
        "recorded_at",
        F.size("tasks").alias("task_count"),
        *runs.RUN_COUNTS,
        "verdict",
    )


@query
def run_history_errors(spark, sf_dir):
    return runs.run_errors(runs_io.read_runs(spark, _run_table(spark, sf_dir)))


def _run_records(spark, sf_dir) -> DataFrame:
    """Records as they were logged, stored with VARIANT columns."""

    def write(path: str) -> None:
        stg = fixture.staging(spark, sf_dir)
        fresh = runs.fresh_summaries(fixture.runs(stg), _summaries(spark, sf_dir))
        texts = fresh.join(fixture.task_records(stg), "run_id", "left").select(
            "run_id",
            "recorded_at",
            "logical_date",
            *[F.col(f"summary.{c}").alias(c) for c in runs.RUN_COUNTS],
            "tasks_json",
            F.to_json("summary").alias("summary_json"),
        )
        columns = {"tasks": "tasks_json", "run_summary_json": "summary_json"}
        runs_io.append_run_records(run_json.parse_records(texts, columns), path)

    return runs_io.read_run_records(spark, written_once(spark, "run-records", sf_dir, write))


@query
def run_task_durations(spark, sf_dir):
    """Tasks as they were logged: an absent duration is told from a NULL one."""
    return run_json.task_durations(_run_records(spark, sf_dir))


@query
def run_record_history(spark, sf_dir):
    history = run_json.run_history(_run_records(spark, sf_dir), limit=100)
    return history.select(
        "run_id",
        "logical_date",
        "recorded_at",
        F.size("tasks").alias("task_count"),
        F.size(F.filter("tasks", lambda t: t["duration"].isNull())).alias("unknown_durations"),
        *runs.RUN_COUNTS,
        "verdict",
    )


@query
def run_record_errors(spark, sf_dir):
    return run_json.run_errors(_run_records(spark, sf_dir))
