"""Refresh the star schema and its marts after silver hours were loaded.

Dimensions and marts always come out as if rebuilt from all events, but the work follows what changed:

* The fact is upserted; the days it touched are known from there.
* Name spellings and dimensions lie in buckets by a hash of their key. Only buckets with a key of the changed
  hours are read, and a dimension's bucket is rewritten only if a row in it is new or renamed.
* Daily counts are recomputed for the touched days.
* A mart is rewritten for the touched days, for days that hold a renamed entity, and, for momentum, for each
  language's next day with events, whose delta refers to a touched one. A language that the seed gives anew
  touches all days of its repositories.

Days of the marts that are about to change are noted before the dimensions are, and the note goes when the marts
are written, so a refresh that was cut short is caught up by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidemark.functions.hours import Hour
from tidemark.functions.keys import day_to_date_key
from tidemark.operators import dims, fact, marts, quality
from tidemark.operators.silver import stg_events
from tidemark.plans.lake import Lake
from tidemark.plans.model_tests import require_passing
from tidemark.schemas import MARTS, SEED
from tidemark.session import file_system, scratch_scope, shuffles_for
from tidemark.sources.fact import latest, read_fact, read_fact_days, write_fact
from tidemark.sources.seed import read_seed
from tidemark.sources.silver import read_silver, read_silver_hours
from tidemark.sources.swaps import folders
from tidemark.sources.tables import (
    read_mart,
    read_table,
    read_table_folders,
    replace_partitions,
    replace_table,
    stage,
)


def _fields(**kinds) -> StructType:
    return StructType([StructField(name, kind) for name, kind in kinds.items()])


BUCKET = "key_bucket"
BUCKETS = 256

REPO_SPELLINGS = _fields(repo_id=LongType(), repo_name=StringType(), last_seen=TimestampType())
ACTOR_SPELLINGS = _fields(actor_id=LongType(), actor_login=StringType(), last_seen=TimestampType())
DIM_REPO = _fields(repo_sk=StringType(), repo_id=LongType(), repo_name=StringType())
DIM_ACTOR = _fields(actor_sk=StringType(), actor_id=LongType(), actor_login=StringType())
REPO_DAYS = _fields(
    repo_sk=StringType(), events=LongType(), stars=LongType(), date_key=LongType()
)
ACTOR_DAYS = _fields(actor_sk=StringType(), contributions=LongType(), date_key=LongType())
LANGUAGE_DAYS = _fields(
    language=StringType(), event_count=LongType(), active_repos=LongType(), date_key=LongType()
)
PENDING_DAYS = _fields(mart=StringType(), date_key=LongType())

DIMENSIONS = ["dim_event_type", "dim_repo", "dim_actor", "dim_date"]


@dataclass
class Refresh:
    """What a refresh did: the fact's touched days, ids that came in two of the hours, partitions rewritten by table."""

    days: list[date] = field(default_factory=list)
    repeated_ids: int = 0
    rewritten: dict[str, list[str]] = field(default_factory=dict)


def refresh_gold(
    spark: SparkSession,
    lake: Lake,
    hours: Sequence[Hour] | None = None,
    full_refresh: bool = False,
) -> Refresh:
    """``_refresh`` with shuffles that suit the loaded silver, and nothing staged left behind."""
    everything = read_silver(spark, lake.silver_events)
    if hours is not None and not full_refresh:
        everything = read_silver_hours(spark, lake.silver_events, hours)
    with scratch_scope(spark), shuffles_for(everything):
        return _refresh(spark, lake, hours, full_refresh)


def _refresh(
    spark: SparkSession,
    lake: Lake,
    hours: Sequence[Hour] | None = None,
    full_refresh: bool = False,
) -> Refresh:
    """Bring gold up to date with the given silver hours.

    Without ``hours`` everything from an hour before the fact's watermark is taken. A full
    refresh rebuilds all of it, which is also what removes rows that left the source.
    """
    if hours is not None and not full_refresh:
        changed = read_silver_hours(spark, lake.silver_events, hours)
    else:
        changed = read_silver(spark, lake.silver_events)
        if not full_refresh:
            loaded = read_fact(spark, lake.gold("fact_events"))
            changed = fact.incremental_slice(changed, loaded)
    stg = stg_events(changed)
    done = Refresh(repeated_ids=_require_staging(stg))

    def table(name: str) -> DataFrame:
        return spark.read.parquet(lake.gold(name))

    done.days = write_fact(
        spark, lake.gold("fact_events"), latest(fact.fact_events(stg)), full_refresh=full_refresh
    )
    touched = read_fact_days(spark, lake.gold("fact_events"), done.days)
    seed = read_seed(spark, lake.seed)
    if full_refresh:
        _rebuild_dims(spark, lake, stg)
    else:
        changes = {name: _dim_changes(spark, lake, stg, name) for name in ("repo", "actor")}
        affected = _affected_days(spark, lake, seed, changes, done.days)
        for name, change in changes.items():
            done.rewritten |= change.write()
    _refresh_small_dims(spark, lake, stg, full_refresh)
    built = {name: table(name) for name in DIMENSIONS}
    # days of the fact that were not touched have passed before
    require_passing({**built, "fact_events": touched, "repo_languages": seed}, table)
    if full_refresh:
        _rebuild_marts(spark, lake, touched, seed)
        ranked = {name: read_mart(spark, lake.gold(name), MARTS[name]) for name in MARTS}
    else:
        ranked = _refresh_marts(spark, lake, touched, seed, affected, done)
    require_passing(ranked, table)
    _drop(spark, lake.gold("pending_days"))
    return done


def _require_staging(stg: DataFrame) -> int:
    """Test the hours as they are; returns how many ids came in more than one of them.

    An id must be unique within its hour. One that comes in the files of two hours is no error, the fact takes
    the latest of it, but it is counted.
    """
    by_hour = F.concat_ws("@", "event_id", "event_date", "event_hour")
    tagged = stg.withColumn("event_id", F.when(F.col("event_id").isNotNull(), by_hour))
    require_passing({"stg_events": tagged})
    return quality.unique(stg, "event_id").count()


# Dimensions


def bucket_of(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias(BUCKET)


def _with_bucket(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BUCKET, IntegerType())])


def _read_buckets(spark: SparkSession, path: str, schema: StructType, buckets: Iterable[int]) -> DataFrame:
    read = read_table_folders(spark, path, _with_bucket(schema), BUCKET, map(str, buckets))
    return read.select(*schema.fieldNames())


def read_dim(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """``dim_repo`` or ``dim_actor`` without the column of its layout."""
    schema = {"dim_repo": DIM_REPO, "dim_actor": DIM_ACTOR}[name]
    return read_table(spark, lake.gold(name), _with_bucket(schema)).select(*schema.fieldNames())


_ENTITIES = {
    "repo": (REPO_SPELLINGS, DIM_REPO, dims.dim_repo_from),
    "actor": (ACTOR_SPELLINGS, DIM_ACTOR, dims.dim_actor_from),
}


def _bucketed(spark: SparkSession, path: str, schema: StructType, key: str) -> None:
    """Give buckets to a table that an earlier version wrote without."""
    fs, at = file_system(spark, path)
    if fs.exists(at) and not folders(spark, path, [f"{BUCKET}=*"]):
        plain = spark.read.schema(schema).parquet(path)
        replace_table(plain.withColumn(BUCKET, bucket_of(key)), path, [BUCKET])


@dataclass
class DimChange:
    """Staged changes of one dimension: merged spellings, its changed buckets, and who was renamed."""

    lake: Lake
    name: str
    spellings: DataFrame
    rows: DataFrame
    renamed: DataFrame

    def write(self) -> dict[str, list[str]]:
        written = {}
        for table, rows in ((f"{self.name}_spellings", self.spellings), (f"dim_{self.name}", self.rows)):
            written[table] = replace_partitions(rows, self.lake.gold(table), [BUCKET])
        return written


def _dim_changes(spark: SparkSession, lake: Lake, stg: DataFrame, name: str) -> DimChange:
    """Work out a dimension's changes from the buckets that the changed hours have keys in."""
    spelled, dim, build = _ENTITIES[name]
    key, attribute, _ = spelled.fieldNames()
    seen_path, dim_path = lake.gold(f"{name}_spellings"), lake.gold(f"dim_{name}")
    _bucketed(spark, seen_path, spelled, key)
    _bucketed(spark, dim_path, dim, key)
    seen = stage(dims.spellings(stg, key, attribute).withColumn(BUCKET, bucket_of(key)), f"{name}-seen")
    # at most BUCKETS numbers
    buckets = [r[0] for r in seen.select(BUCKET).distinct().collect()]
    known = _read_buckets(spark, seen_path, spelled, buckets)
    merged = dims.merge_spellings(known, seen.drop(BUCKET), key, attribute)
    merged = stage(merged.withColumn(BUCKET, bucket_of(key)), f"{name}-spellings")
    old = _read_buckets(spark, dim_path, dim, buckets).select(F.col(key).alias("old_key"), F.col(attribute).alias("was"))
    new = build(merged).withColumn(BUCKET, bucket_of(key))
    joined = new.join(old.withColumn("known", F.lit(True)), F.col(key).eqNullSafe(F.col("old_key")), "left")
    other = F.col("known").isNull() | ~F.col(attribute).eqNullSafe(F.col("was"))
    judged = stage(joined.withColumn("changed", other), f"{name}-changes")
    changed = [r[0] for r in judged.where("changed").select(BUCKET).distinct().collect()]
    rows = judged.where(F.col(BUCKET).isin(changed)).select(*dim.fieldNames(), BUCKET)
    renamed = judged.where("changed AND known").select(dim.fieldNames()[0])
    return DimChange(lake, name, merged, rows, renamed)


def _rebuild_dims(spark: SparkSession, lake: Lake, stg: DataFrame) -> None:
    for name, (spelled, _, build) in _ENTITIES.items():
        key, attribute, _ = spelled.fieldNames()
        path = lake.gold(f"{name}_spellings")
        seen = dims.spellings(stg, key, attribute)
        replace_table(seen.withColumn(BUCKET, bucket_of(key)), path, [BUCKET])
        stored = read_table(spark, path, _with_bucket(spelled)).drop(BUCKET)
        replace_table(build(stored).withColumn(BUCKET, bucket_of(key)), lake.gold(f"dim_{name}"), [BUCKET])


def _refresh_small_dims(spark: SparkSession, lake: Lake, stg: DataFrame, full_refresh: bool) -> None:
    types = dims.dim_event_type(stg)
    if not full_refresh:
        known = read_table(spark, lake.gold("dim_event_type"), types.schema)
        types = known.unionByName(types).distinct()
    replace_table(types, lake.gold("dim_event_type"))
    calendar = dims.dim_date(spark, lake.calendar_start, lake.calendar_end)
    replace_table(calendar, lake.gold("dim_date"))


# Which days of the marts change


def _days(rows: DataFrame) -> set[int]:
    """Distinct days, bounded by the calendar."""
    return {r.date_key for r in rows.select("date_key").distinct().collect()}


def _days_with(counts: DataFrame, changed: DataFrame) -> set[int]:
    """Days on which any of the changed entities has counts; two columns of the counts are read for it."""
    if changed.isEmpty():
        return set()
    return _days(counts.join(changed, changed.columns[0], "left_semi"))


def _relabelled(spark: SparkSession, lake: Lake, seed: DataFrame, repo: DataFrame) -> DataFrame:
    """repo_sk of repositories whose language the seed changed since the last refresh."""
    known = read_table(spark, lake.gold("repo_languages"), StructType.fromDDL(SEED))
    tell = F.struct("language")
    was = known.select("repo_id", tell.alias("was"))
    is_now = seed.select("repo_id", tell.alias("now"))
    other = is_now.join(was, "repo_id", "full").where("NOT (was <=> now)")
    return repo.join(other, "repo_id", "left_semi").select("repo_sk")


def _affected_days(
    spark: SparkSession, lake: Lake, seed: DataFrame, changes: dict[str, DimChange], days: Iterable[date]
) -> dict[str, set[int]]:
    """Days of each mart to be written anew, without momentum's next days. They are noted until they are written."""
    touched = {day_to_date_key(day) for day in days}
    repo_days = read_table(spark, lake.gold("repo_days"), REPO_DAYS)
    actor_days = read_table(spark, lake.gold("actor_days"), ACTOR_DAYS)
    relabelled = _relabelled(spark, lake, seed, read_dim(spark, lake, "dim_repo"))
    affected = {
        "trending_repos_daily": touched | _days_with(repo_days.where("stars > 0"), changes["repo"].renamed),
        "contributor_leaderboard": touched | _days_with(actor_days, changes["actor"].renamed),
        "language_momentum": touched | _days_with(repo_days, relabelled),
    }
    fs, at = file_system(spark, lake.gold("language_days"))
    if not fs.exists(at):
        affected["language_momentum"] |= _days(repo_days)
    path = lake.gold("pending_days")
    for r in read_table(spark, path, PENDING_DAYS).collect():
        affected[r.mart].add(r.date_key)
    noted = [(mart, day) for mart, of in affected.items() for day in sorted(of)]
    replace_table(spark.createDataFrame(noted, PENDING_DAYS).coalesce(1), path)
    return affected


def _drop(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


# Counts and marts


def _rebuild_marts(spark: SparkSession, lake: Lake, touched: DataFrame, seed: DataFrame) -> None:
    replace_table(marts.repo_days(touched), lake.gold("repo_days"), ["date_key"])
    replace_table(marts.contributions_per_actor_day(touched), lake.gold("actor_days"), ["date_key"])
    repo, actor = read_dim(spark, lake, "dim_repo"), read_dim(spark, lake, "dim_actor")
    repo_days = read_table(spark, lake.gold("repo_days"), REPO_DAYS)
    actor_days = read_table(spark, lake.gold("actor_days"), ACTOR_DAYS)
    replace_table(marts.count_languages(repo_days, repo, seed), lake.gold("language_days"), ["date_key"])
    _keep_seed(lake, seed)
    languages = read_table(spark, lake.gold("language_days"), LANGUAGE_DAYS)
    for table, mart in (
        ("trending_repos_daily", marts.rank_trending(repo_days.where("stars > 0"), repo)),
        ("contributor_leaderboard", marts.rank_contributors(actor_days, actor)),
        ("language_momentum", marts.momentum_of(languages)),
    ):
        replace_table(mart, lake.gold(table), ["date_key"], ["daily_rank"])


def _keep_seed(lake: Lake, seed: DataFrame) -> None:
    replace_table(seed.select("repo_id", "language").coalesce(1), lake.gold("repo_languages"))


def _owned(days: Iterable[int]) -> list[Row]:
    return [Row(date_key=day) for day in sorted(days)]


def _next_days(before: DataFrame, after: DataFrame, languages: DataFrame) -> set[int]:
    """For each language whose events on a rewritten day are more or fewer than before, its next day with events."""
    counted = ["language", "date_key", "event_count"]
    was, now = before.select(*counted), after.select(*counted)
    changed = was.exceptAll(now).unionByName(now.exceptAll(was)).select("language", "date_key").distinct()
    marked = changed.withColumn("present", F.lit(False)).unionByName(
        languages.select("language", "date_key", F.lit(True).alias("present"))
    )
    later = Window.partitionBy("language").orderBy("date_key").rangeBetween(1, Window.unboundedFollowing)
    following = F.min(F.when(F.col("present"), F.col("date_key"))).over(later)
    found = marked.withColumn("next_key", following).where("NOT present AND next_key IS NOT NULL")
    return _days(found.select(F.col("next_key").alias("date_key")))


def _refresh_marts(
    spark: SparkSession,
    lake: Lake,
    touched: DataFrame,
    seed: DataFrame,
    affected: dict[str, set[int]],
    done: Refresh,
) -> dict[str, DataFrame]:
    """Write the affected days of counts and marts; returns the rewritten rows of each mart."""
    owned = _owned(day_to_date_key(day) for day in done.days)

    def write(name: str, rows: DataFrame, days: list[Row], sort_by: Sequence[str] = ()) -> None:
        done.rewritten[name] = replace_partitions(rows, lake.gold(name), ["date_key"], sort_by, days)

    def read(name: str, schema: StructType, days: Iterable[int]) -> DataFrame:
        return read_table_folders(spark, lake.gold(name), schema, "date_key", map(str, days))

    write("repo_days", marts.repo_days(touched), owned)
    write("actor_days", marts.contributions_per_actor_day(touched), owned)

    repo, actor = read_dim(spark, lake, "dim_repo"), read_dim(spark, lake, "dim_actor")
    language_days = affected["language_momentum"]
    before = stage(read("language_days", LANGUAGE_DAYS, language_days), "language-days")
    counted = marts.count_languages(read("repo_days", REPO_DAYS, language_days), repo, seed)
    write("language_days", counted, _owned(language_days))
    _keep_seed(lake, seed)
    languages = read_table(spark, lake.gold("language_days"), LANGUAGE_DAYS)
    after = read("language_days", LANGUAGE_DAYS, language_days)
    affected["language_momentum"] = language_days | _next_days(before, after, languages)

    def built(mart: str, days: set[int]) -> DataFrame:
        if mart == "trending_repos_daily":
            return marts.rank_trending(read("repo_days", REPO_DAYS, days).where("stars > 0"), repo)
        if mart == "contributor_leaderboard":
            return marts.rank_contributors(read("actor_days", ACTOR_DAYS, days), actor)
        # one row for each language and day: few enough to work out whole, but written by day
        return marts.momentum_of(languages).where(F.col("date_key").isin(sorted(days)))

    ranked = {}
    for mart, days in affected.items():
        write(mart, built(mart, days), _owned(days), ["daily_rank"])
        schema: Callable = MARTS[mart]
        ranked[mart] = read(mart, schema, days)
    return ranked


def reconcile(spark: SparkSession, lake: Lake) -> DataFrame:
    return quality.mart_reconciliation(
        read_fact(spark, lake.gold("fact_events")),
        read_dim(spark, lake, "dim_repo"),
        *[read_mart(spark, lake.gold(name), schema) for name, schema in MARTS.items()],
    )
