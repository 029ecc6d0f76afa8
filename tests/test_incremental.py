"""Which partitions of gold an hour rewrites, and that the tables equal a rebuild each time."""

import shutil
from datetime import date

import pytest
from conftest import rows
from helpers import raw_row

from pyspark.sql import functions as F

from tidemark.functions.keys import day_to_date_key
from tidemark.plans import gold
from tidemark.plans.lake import Lake
from tidemark.operators.silver import transform_events
from tidemark.schemas import MARTS
from tidemark.sources import silver as silver_io
from tidemark.sources.tables import read_mart, read_table

from helpers import sourced_frame

MART_NAMES = list(MARTS)
DAYS = [date(2024, 1, d) for d in (1, 2, 4, 7)]


def put(spark, lake, day, hour, raw):
    """Load an hour's rows into the warehouse table."""
    events = transform_events(sourced_frame(spark, raw, day, hour))
    good = events.where("created_at IS NOT NULL")
    silver_io.load_hours(good.select(*silver_io.SILVER.fieldNames()), lake.silver_events, [(day, hour)])
    return [(day, hour)]


def seeded(spark, lake, languages):
    seed = spark.createDataFrame(languages, "repo_id bigint, language string")
    seed.coalesce(1).write.mode("overwrite").option("header", True).csv(lake.seed)


def at(day, hour, minute=0):
    return f"{day.isoformat()}T{hour:02d}:{minute:02d}:00Z"


def star(i, day, hour, repo, name, actor=1, login="ann", kind="WatchEvent"):
    return raw_row(f"{i}", at(day, hour, i % 60), kind, (actor, login), (repo, name))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Four days, taken to gold once; every test gets a copy."""
    lake = Lake(str(tmp_path_factory.mktemp("built") / "lake"))
    seeded(spark, lake, [(1, "Go"), (2, "Rust")])
    events = {
        DAYS[0]: [star(1, DAYS[0], 5, 1, "a/one"), star(2, DAYS[0], 5, 2, "a/two", 2, "bob", "PushEvent")],
        DAYS[1]: [star(3, DAYS[1], 5, 1, "a/one"), star(4, DAYS[1], 5, 3, "a/three", 1, "ann", "PushEvent")],
        DAYS[2]: [star(5, DAYS[2], 5, 2, "a/two"), star(6, DAYS[2], 5, 2, "a/two", 2, "bob", "PushEvent")],
        DAYS[3]: [star(7, DAYS[3], 5, 1, "a/one"), star(8, DAYS[3], 5, 3, "a/three")],
    }
    hours = [hour for day, raw in events.items() for hour in put(spark, lake, day, 5, raw)]
    gold.refresh_gold(spark, lake, hours)
    return lake


@pytest.fixture
def lake(built, tmp_path):
    return Lake(shutil.copytree(built.root, str(tmp_path / "lake")))


def state(spark, lake):
    marts = {name: rows(read_mart(spark, lake.gold(name), MARTS[name])) for name in MART_NAMES}
    dims = {name: rows(gold.read_dim(spark, lake, name)) for name in ("dim_repo", "dim_actor")}
    counts = {n: rows(read_table(spark, lake.gold(n), s)) for n, s in (("language_days", gold.LANGUAGE_DAYS),)}
    return {**marts, **dims, **counts}


def equals_a_rebuild(spark, lake, tmp_path):
    """The same warehouse table and seed, taken to gold at once."""
    other = Lake(str(tmp_path / f"rebuilt-{len(list(tmp_path.iterdir()))}"))
    spark.read.option("basePath", lake.silver_events).parquet(lake.silver_events).write.partitionBy(
        "event_date", "event_hour"
    ).parquet(other.silver_events)
    spark.read.option("header", True).csv(lake.seed).write.option("header", True).csv(other.seed)
    gold.refresh_gold(spark, other, full_refresh=True)
    assert state(spark, lake) == state(spark, other)


def keys(*days):
    return [f"date_key={day_to_date_key(day)}" for day in days]


def rewritten(done, *names):
    return {name: done.rewritten[name] for name in names}


def test_an_hour_rewrites_its_day_and_the_next_of_its_languages(spark, lake, tmp_path):
    hours = put(spark, lake, DAYS[1], 6, [star(10, DAYS[1], 6, 1, "a/one")])
    done = gold.refresh_gold(spark, lake, hours)
    assert done.days == [DAYS[1]]
    assert rewritten(done, "trending_repos_daily", "contributor_leaderboard", "repo_days", "actor_days") == {
        "trending_repos_daily": keys(DAYS[1]),
        "contributor_leaderboard": keys(DAYS[1]),
        "repo_days": keys(DAYS[1]),
        # the leaderboard's day had contributions before
        "actor_days": keys(DAYS[1]),
    }
    # Go of the 2nd is next seen on the 7th, not on the 4th
    assert done.rewritten["language_momentum"] == keys(DAYS[1], DAYS[3])
    # nothing in a dimension is new, though the spelling was seen again
    assert done.rewritten["dim_repo"] == done.rewritten["dim_actor"] == []
    assert len(done.rewritten["repo_spellings"]) == 1
    equals_a_rebuild(spark, lake, tmp_path)


def test_files_of_other_days_stay_as_they_are(spark, lake, tmp_path):
    def files():
        found = (tmp_path / "lake" / "gold").rglob("*.parquet")
        return {str(f.relative_to(tmp_path)) for f in found if "date_key=" in str(f)}

    before = files()
    gold.refresh_gold(spark, lake, put(spark, lake, DAYS[3], 6, [star(10, DAYS[3], 6, 2, "a/two")]))
    gone = {f for f in before - files()}
    assert gone and all(keys(DAYS[3])[0] in f for f in gone)
    equals_a_rebuild(spark, lake, tmp_path)


def test_a_renamed_repository_rewrites_the_days_that_show_it(spark, lake, tmp_path):
    hours = put(spark, lake, DAYS[3], 6, [star(10, DAYS[3], 6, 2, "b/two", 2, "bobby")])
    done = gold.refresh_gold(spark, lake, hours)
    # 2 was starred on the 4th and, now, on the 7th; its pushes do not show in trending
    assert done.rewritten["trending_repos_daily"] == keys(DAYS[2], DAYS[3])
    # bob contributed on the 1st and the 4th
    assert done.rewritten["contributor_leaderboard"] == keys(DAYS[0], DAYS[2])
    assert done.rewritten["language_momentum"] == keys(DAYS[3])
    assert len(done.rewritten["dim_repo"]) == len(done.rewritten["dim_actor"]) == 1
    trending = read_mart(spark, lake.gold("trending_repos_daily"), MARTS["trending_repos_daily"])
    assert {r.repo_name for r in trending.where("repo_id = 2").collect()} == {"b/two"}
    equals_a_rebuild(spark, lake, tmp_path)


def test_a_changed_seed_rewrites_the_days_of_its_repositories(spark, lake, tmp_path):
    seeded(spark, lake, [(1, "Go"), (2, "Zig"), (99, "C")])
    hours = put(spark, lake, DAYS[3], 6, [star(10, DAYS[3], 6, 1, "a/one")])
    done = gold.refresh_gold(spark, lake, hours)
    # 2 has events on the 1st and the 4th, the 7th was touched, and the 2nd follows the 1st in neither Rust nor Zig
    assert done.rewritten["language_momentum"] == keys(DAYS[0], DAYS[2], DAYS[3])
    assert done.rewritten["trending_repos_daily"] == keys(DAYS[3])
    equals_a_rebuild(spark, lake, tmp_path)


def test_a_language_that_leaves_a_day_moves_the_next_delta(spark, lake, tmp_path):
    # the only Rust star of the 4th goes to another day; Rust's next day is the 7th by then
    gold.refresh_gold(spark, lake, put(spark, lake, DAYS[3], 6, [star(10, DAYS[3], 6, 2, "a/two")]))
    moved = [star(5, DAYS[3], 7, 2, "a/two"), star(6, DAYS[3], 7, 2, "a/two", 2, "bob", "PushEvent")]
    hours = put(spark, lake, DAYS[3], 7, moved)
    done = gold.refresh_gold(spark, lake, hours)
    assert sorted(done.days) == [DAYS[2], DAYS[3]]
    assert done.rewritten["trending_repos_daily"] == keys(DAYS[2], DAYS[3])
    momentum = read_mart(spark, lake.gold("language_momentum"), MARTS["language_momentum"])
    got = rows(momentum.where("language = 'Rust'"), "date_key", "event_count", "momentum_delta")
    assert got == [(20240101, 1, None), (20240107, 3, 2)]
    assert rows(read_table(spark, lake.gold("language_days"), gold.LANGUAGE_DAYS).where("date_key = 20240104")) == []


def test_a_refresh_cut_short_is_caught_up(spark, lake, tmp_path, monkeypatch):
    hours = put(spark, lake, DAYS[3], 6, [star(10, DAYS[3], 6, 2, "b/two")])

    def dead(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(gold, "_refresh_marts", dead)
        with pytest.raises(RuntimeError):
            gold.refresh_gold(spark, lake, hours)
    # the dimension has the new name by now, so only the note tells of the older days
    more = put(spark, lake, DAYS[3], 8, [star(11, DAYS[3], 8, 3, "a/three")])
    done = gold.refresh_gold(spark, lake, more)
    assert done.rewritten["trending_repos_daily"] == keys(DAYS[2], DAYS[3])
    trending = read_mart(spark, lake.gold("trending_repos_daily"), MARTS["trending_repos_daily"])
    assert {r.repo_name for r in trending.where("repo_id = 2").collect()} == {"b/two"}
    assert read_table(spark, lake.gold("pending_days"), gold.PENDING_DAYS).count() == 0


def test_dimensions_without_buckets_are_taken_over(spark, lake, tmp_path):
    for name, (spelled, dim, _) in gold._ENTITIES.items():
        for table, schema in ((f"{name}_spellings", spelled), (f"dim_{name}", dim)):
            plain = read_table(spark, lake.gold(table), gold._with_bucket(schema)).drop(gold.BUCKET).collect()
            spark.createDataFrame(plain, schema).write.mode("overwrite").parquet(lake.gold(table))
    gold.refresh_gold(spark, lake, put(spark, lake, DAYS[3], 6, [star(10, DAYS[3], 6, 2, "b/two")]))
    equals_a_rebuild(spark, lake, tmp_path)


def test_only_the_buckets_of_the_hour_are_read(spark, lake):
    path = lake.gold("dim_repo")
    (bucket,) = {r[0] for r in spark.range(2, 3).select(gold.bucket_of("id")).collect()}
    read = gold._read_buckets(spark, path, gold.DIM_REPO, [bucket])
    assert {f.split(f"{gold.BUCKET}=")[1].split("/")[0] for f in read.inputFiles()} == {str(bucket)}
    assert 2 in {r.repo_id for r in read.collect()}


def test_ids_in_two_hours_are_counted_and_in_one_refused(spark, lake):
    from tidemark.plans.model_tests import ModelTestError

    hours = put(spark, lake, DAYS[2], 8, [star(20, DAYS[2], 8, 1, "a/one"), star(21, DAYS[2], 8, 1, "a/one")])
    hours += put(spark, lake, DAYS[3], 8, [star(20, DAYS[3], 8, 1, "a/one")])
    assert gold.refresh_gold(spark, lake, hours).repeated_ids == 1
    # written past the de-duplication
    twice = read_table(spark, lake.silver_events, silver_io.SILVER).where("event_id = '21'")
    both = twice.unionByName(twice.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 MINUTE")))
    silver_io.load_hours(both, lake.silver_events, [(DAYS[2], 8)])
    with pytest.raises(ModelTestError, match="stg_events unique"):
        gold.refresh_gold(spark, lake, [(DAYS[2], 8)])
