"""The given ``events`` table seen as public developer-activity events.

Adapters only: every frame here is the whole table in another form, with ids, renames and,
in the dirty form, copies and bad timestamps derived from its own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.silver import stg_events
from tidemark.session import scratch_path, use_utc, written_once
from tidemark.sources.bronze import land_bronze
from tidemark.sources.seed import read_seed

RENAME_DAY = "2024-01-16"

# Which activity stands for which event type; anything else is a fork.
EVENT_TYPE_OF = {
    "click": "PushEvent",
    "view": "WatchEvent",
    "purchase": "PullRequestEvent",
    "signup": "CreateEvent",
}
OTHER_TYPE = "ForkEvent"

# Language by repo_id modulo 5; 3 is left out of the seed.
LANGUAGE_OF = ["Python", "Go", "TypeScript", None, "Rust"]


def _event_type() -> Column:
    kind = F.when(F.lit(False), OTHER_TYPE)
    for activity, event_type in EVENT_TYPE_OF.items():
        kind = kind.when(F.col("event_type") == activity, event_type)
    return kind.otherwise(OTHER_TYPE)


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean silver rows. The table's event ids are unique already."""
    use_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ts = F.col("ts").cast("timestamp")
    # props is always {"k": n}; a pattern reads it four times as fast as a JSON parser
    repo = F.regexp_extract("props", r'"k":\s*(-?\d+)', 1).try_cast("bigint")
    renamed = ts >= F.lit(RENAME_DAY).cast("timestamp")
    login_suffix = F.when((F.col("user_id") % 5 == 0) & renamed, "_v2").otherwise("")
    name_suffix = F.when((repo % 7 == 0) & renamed, "-renamed").otherwise("")
    created = F.date_trunc("second", ts)
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        _event_type().alias("event_type"),
        F.col("user_id").alias("actor_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), login_suffix).alias("actor_login"),
        repo.alias("repo_id"),
        F.concat(F.lit("org/repo"), repo.cast("string"), name_suffix).alias("repo_name"),
        F.lit(True).alias("public"),
        created.alias("created_at"),
        F.to_date(created).alias("event_date"),
        F.hour(created).alias("event_hour"),
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_events(silver_events(spark, sf_dir))


def seed(stg: DataFrame) -> DataFrame:
    """Language seed over the repositories present, with one in five left out."""
    position = (F.col("repo_id") % 5).cast("int")
    language = F.get(F.array(*[F.lit(name) for name in LANGUAGE_OF]), position)
    repos = stg.select("repo_id").where("repo_id % 5 <> 3").distinct()
    return repos.withColumn("language", language)


def raw_events(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Nested raw events with the hour file each is dumped in.

    The dirty form repeats every 50th event once, in turn exactly, a second later under another login,
    and in the next hour's file. Every 97th event has a broken timestamp, every 211th no id, every 173rd
    no actor.
    """
    silver = silver_events(spark, sf_dir)
    pattern = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    copies = F.array(F.lit(0))
    if not dirty:
        silver = silver.withColumn("copy", F.explode(copies)).withColumn("time", F.date_format("created_at", pattern))
        actor = F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login"))
        event_id = F.col("event_id")
    else:
        event = F.col("event_id").cast("bigint")
        twice = F.array(F.lit(0), F.pmod(F.floor(event / 50), F.lit(3)).cast("int") + 1)
        silver = silver.withColumn("copy", F.explode(F.when(event % 50 == 0, twice).otherwise(copies)))
        later = F.col("copy") == 2
        moved = F.when(later, F.col("created_at") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("created_at"))
        time = F.when(event % 97 == 0, "not-a-timestamp").otherwise(F.date_format(moved, pattern))
        # the copy of another hour lies in the file after its own
        file_time = F.when(F.col("copy") == 3, F.col("created_at") + F.expr("INTERVAL 1 HOUR")).otherwise(
            F.col("created_at")
        )
        silver = (
            silver.withColumn("time", time)
            .withColumn("event_date", F.to_date(file_time))
            .withColumn("event_hour", F.hour(file_time))
        )
        login = F.when(later, F.concat("actor_login", F.lit("_x"))).otherwise(F.col("actor_login"))
        someone = event % 173 != 0
        actor = F.struct(
            F.when(someone, F.col("actor_id")).alias("id"), F.when(someone, login).alias("login")
        )
        event_id = F.when(event % 211 != 0, F.col("event_id"))
    return silver.select(
        event_id.alias("id"),
        F.col("event_type").alias("type"),
        "public",
        F.col("time").alias("created_at"),
        actor.alias("actor"),
        F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
        F.col("event_date").alias("source_date"),
        F.col("event_hour").alias("source_hour"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw events as JSON text. The payload must not get past bronze."""
    payload = F.struct(F.lit("someone@example.org").alias("email")).alias("payload")
    fields = ["id", "type", "public", "created_at", "actor", "repo", payload]
    raw = raw_events(spark, sf_dir, dirty=True)
    return raw.select(F.to_json(F.struct(*fields)).alias("value"), "source_date", "source_hour")


def landed_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Root of the dirty events as gzipped hour files."""
    return written_once(
        spark, "bronze", sf_dir, lambda root: land_bronze(raw_lines(spark, sf_dir), root)
    )


def seed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "seed")
    seed(staging(spark, sf_dir)).write.option("header", True).csv(path)
    return read_seed(spark, path)


# Run records: every hour with events is a run, and its event types are the run's tasks.


def _hour_start() -> Column:
    return F.date_trunc("hour", "created_at")


def _run_id(hour: Column) -> Column:
    return F.concat(F.lit("scheduled__"), F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss"))


def runs(stg: DataFrame) -> DataFrame:
    hours = stg.select(_hour_start().alias("logical_date")).distinct()
    return hours.select(
        _run_id(F.col("logical_date")).alias("run_id"),
        (F.col("logical_date") + F.expr("INTERVAL 65 MINUTES")).alias("run_start"),
        "logical_date",
        (F.col("logical_date") + F.expr("INTERVAL 70 MINUTES")).alias("recorded_at"),
    )


def tasks(stg: DataFrame) -> DataFrame:
    """A task fails at an event count divisible by 5, and then has no duration."""
    per_type = stg.groupBy(_run_id(_hour_start()).alias("run_id"), "event_type").agg(
        F.count("*").alias("n")
    )
    failed = F.col("n") % 5 == 0
    return per_type.select(
        "run_id",
        F.col("event_type").alias("task_id"),
        F.when(failed, "failed").otherwise("success").alias("state"),
        F.when(~failed, F.col("n") * 0.5).cast("double").alias("duration"),
    )


def nameless_tasks(stg: DataFrame) -> DataFrame:
    """The same tasks, but forks of the hour 13 lost their id."""
    lost = F.col("run_id").contains("T13:") & (F.col("task_id") == OTHER_TYPE)
    return tasks(stg).withColumn("task_id", F.when(~lost, F.col("task_id")))


def task_records(stg: DataFrame) -> DataFrame:
    """(run_id, tasks_json): the tasks as a logger wrote them. By hour, type and number of events, a task has a
    duration, a NULL one, or no such field."""
    per_type = stg.groupBy(_hour_start().alias("hour"), "event_type").agg(F.count("*").alias("n"))
    kind = (F.length("event_type") + F.hour("hour") + F.col("n")) % 4
    base = [F.col("event_type").alias("task_id"), F.lit("success").alias("state")]
    duration = F.when(kind != 1, F.col("n") * 0.5).cast("double").alias("duration")
    whole = F.to_json(F.struct(*base, duration), {"ignoreNullFields": "false"})
    task = F.when(kind == 0, F.to_json(F.struct(*base))).otherwise(whole)
    placed = F.array_sort(F.collect_list(F.struct("event_type", task.alias("task"))))
    texts = F.concat_ws(",", F.transform(placed, lambda t: t["task"]))
    return per_type.groupBy(_run_id(F.col("hour")).alias("run_id")).agg(
        F.concat(F.lit("["), texts, F.lit("]")).alias("tasks_json")
    )


def summary_times(verdict: DataFrame) -> DataFrame:
    """Stamp each hour's summary one minute into its run; in every third hour, before it."""
    start = F.col("partition_date").cast("timestamp")
    minutes = F.when(F.col("partition_hour") % 3 == 0, 60).otherwise(66)
    stamp = start + F.make_dt_interval(hours=F.col("partition_hour"), mins=minutes)
    return verdict.withColumn("timestamp", stamp)
