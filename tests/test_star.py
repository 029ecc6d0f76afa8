import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from helpers import event, silver_frame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.keys import date_key, day_to_date_key, surrogate_key
from tidemark.operators import dims, fact, joins, marts, pages
from tidemark.operators.ranking import with_daily_rank
from tidemark.operators.silver import stg_events
from tidemark.sources import fact as fact_io


def test_surrogate_key_of_null_and_pairs(spark):
    df = spark.createDataFrame([(1, 2), (None, 2)], "a bigint, b bigint")
    got = rows(df.select(surrogate_key("a"), surrogate_key("a", "b")))
    import hashlib

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    null = "_dbt_utils_surrogate_key_null_"
    assert got == sorted([(md5("1"), md5("1-2")), (md5(null), md5(f"{null}-2"))], key=repr)


def test_calendar_is_gap_free(spark):
    calendar = dims.dim_date(spark)
    assert calendar.count() == 366
    by_key = {r.date_key: r for r in calendar.collect()}
    assert by_key[20240101].day_name == "Monday" and by_key[20240101].day_of_week == 2
    assert by_key[20240106].is_weekend and by_key[20240107].day_of_week == 1
    assert min(by_key) == 20240101 and max(by_key) == 20241231
    assert dims.dim_date(spark, "2023-12-31", "2024-03-01").count() == 61
    with pytest.raises(ValueError):
        dims.dim_date(spark, "2024-01-01", "2024-01-01")


def test_calendar_for_events_covers_their_years(spark):
    stg = stg_events(
        silver_frame(spark, [event("1", "2023-06-01 00:00"), event("2", "2024-02-01 00:00")])
    )
    assert dims.dim_date_for(stg).count() == 365 + 366


def test_latest_name_wins_whatever_the_order(spark):
    events = [
        event("1", "2024-01-01 10:00", repo=(7, "old")),
        event("2", "2024-01-02 10:00", repo=(7, "new")),
        event("3", "2024-01-01 12:00", repo=(7, "old")),
        event("4", "2024-01-01 12:00", repo=(None, "nobody")),
    ]
    for order in (events, events[::-1]):
        repo = dims.dim_repo(stg_events(silver_frame(spark, order)))
        assert rows(repo, "repo_id", "repo_name") == [(7, "new"), (None, "nobody")]


def test_merged_spellings_equal_a_rebuild(spark):
    events = [
        event(str(i), f"2024-01-{1 + i % 9:02d} 10:00", repo=(i % 3, f"n{i % 5}"))
        for i in range(60)
    ]
    whole = stg_events(silver_frame(spark, events))
    seen = dims.spellings(stg_events(silver_frame(spark, events[:25])), "repo_id", "repo_name")
    for part in (events[25:], events[25:40]):
        new = dims.spellings(stg_events(silver_frame(spark, part)), "repo_id", "repo_name")
        seen = dims.merge_spellings(seen, new, "repo_id", "repo_name")
    assert rows(dims.dim_repo_from(seen)) == rows(dims.dim_repo(whole))


def _fact(spark, events):
    return fact.fact_events(stg_events(silver_frame(spark, events)))


def test_fact_keys_join_to_dims(spark):
    events = [event("1", "2024-01-01 10:00"), event("2", "2024-02-29 10:00", repo=(None, None))]
    stg = stg_events(silver_frame(spark, events))
    f = fact.fact_events(stg)
    assert f.join(dims.dim_repo(stg), "repo_sk").count() == 2
    assert rows(f, "date_key") == [(20240101,), (20240229,)]


def _random_events(n, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    kinds = ["WatchEvent", "PushEvent", "ForkEvent", "CreateEvent"]
    return [
        event(
            str(i),
            (start + timedelta(minutes=rng.randrange(4 * 24 * 60))).isoformat(),
            rng.choice(kinds),
            (a := rng.randrange(12), f"actor{a}"),
            (r := min(rng.randrange(40), rng.randrange(40)), f"repo{r}"),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_over_any_split_equals_a_full_build(spark, tmp_path, seed):
    events = _random_events(200, seed)
    random.Random(seed).shuffle(events)
    path = str(tmp_path / "fact")
    for part in (events[:90], events[60:150], events[140:], events[140:]):
        fact_io.write_fact(spark, path, _fact(spark, part))
    assert rows(fact_io.read_fact(spark, path)) == rows(_fact(spark, events))


def test_upsert_moves_a_row_between_days(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact_io.write_fact(spark, path, _fact(spark, [event("1", "2024-01-01 10:00")]))
    moved = _fact(spark, [event("1", "2024-01-02 10:00", "WatchEvent")])
    days = fact_io.write_fact(spark, path, moved)
    assert sorted(days) == [date(2024, 1, 1), date(2024, 1, 2)]
    assert rows(fact_io.read_fact(spark, path), "event_id", "date_key") == [("1", 20240102)]


def test_upsert_rejects_repeats_and_drift(spark, tmp_path):
    twice = _fact(spark, [event("1", "2024-01-01 10:00"), event("1", "2024-01-01 11:00")])
    with pytest.raises(ValueError, match="repeat"):
        fact_io.write_fact(spark, str(tmp_path / "f"), twice)
    drifted = _fact(spark, [event("1", "2024-01-01 10:00")]).withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="extra"):
        fact_io.write_fact(spark, str(tmp_path / "f"), drifted)


def test_full_refresh_removes_rows_that_left(spark, tmp_path):
    path = str(tmp_path / "fact")
    events = _random_events(50, 3)
    fact_io.write_fact(spark, path, _fact(spark, events))
    fact_io.write_fact(spark, path, _fact(spark, events[:10]), full_refresh=True)
    assert fact_io.read_fact(spark, path).count() == 10


def test_watermark_slice(spark):
    events = _random_events(100, 4)
    stg = stg_events(silver_frame(spark, events))
    loaded = fact.fact_events(fact.between(stg, None, datetime(2024, 1, 3)))
    (mark,) = fact.watermark(loaded).first()
    late = fact.incremental_slice(stg, loaded)
    expected = [e[0] for e in events if e[7] >= mark - timedelta(hours=1)]
    assert rows(late, "event_id") == sorted(((e,) for e in expected), key=repr)
    # an empty fact takes everything, and a range reaches behind the watermark
    assert fact.incremental_slice(stg, loaded.limit(0)).count() == 100
    old = fact.incremental_slice(
        stg, loaded, since=datetime(2024, 1, 1, 5), until=datetime(2024, 1, 1, 20)
    )
    assert old.count() == sum(
        datetime(2024, 1, 1, 5) <= e[7] < datetime(2024, 1, 1, 20) for e in events
    )


@pytest.mark.parametrize("seed", [5, 6])
def test_daily_rank_equals_the_window(spark, seed):
    rng = random.Random(seed)
    data = [
        (20240101 + d, f"e{i}", min(int(rng.paretovariate(0.7)), 10**9))
        for d in range(3)
        for i in range(400)
    ] + [(None, "e1", 3), (None, "e2", 3), (None, "e3", 1)]
    df = spark.createDataFrame(data, "date_key bigint, entity string, stars bigint")
    window = Window.partitionBy("date_key").orderBy(F.desc("stars"))
    expected = df.withColumn("daily_rank", F.rank().over(window).cast("bigint"))
    assert rows(with_daily_rank(df, "stars", "entity")) == rows(expected)


def test_hot_key_join_equals_the_plain_join(spark):
    data = [(i, 0 if i % 3 == 0 else i % 500) for i in range(3000)]
    left = spark.createDataFrame(data, "id bigint, k bigint")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 400)], "k bigint, v string")
    assert joins.hot_keys(left, "k", share=10).collect() == [(0,)]
    got = rows(joins.join_lookup(left, right, "k"), "id", "k", "v")
    assert got == rows(left.join(right, "k"), "id", "k", "v")


def test_marts_on_hand_made_days(spark):
    events = [
        event("1", "2024-01-01 10:00", "WatchEvent", repo=(1, "one")),
        event("2", "2024-01-01 10:00", "WatchEvent", repo=(1, "one")),
        event("3", "2024-01-01 10:00", "WatchEvent", repo=(2, "two")),
        event("4", "2024-01-01 10:00", "WatchEvent", repo=(3, "three")),
        event("5", "2024-01-03 10:00", "WatchEvent", repo=(3, "three!")),
        event("6", "2024-01-03 10:00", "ForkEvent", (9, "zoe"), (4, "four")),
        event("7", "2024-01-03 10:00", "PushEvent", (9, "zoe"), (4, "four")),
    ]
    stg = stg_events(silver_frame(spark, events))
    f, repo, actor = fact.fact_events(stg), dims.dim_repo(stg), dims.dim_actor(stg)
    seed = spark.createDataFrame([(1, "Go"), (3, "Go"), (99, "C")], "repo_id bigint, language string")

    trending = marts.trending_repos_daily(f, repo)
    assert rows(trending, "date_key", "repo_name", "stars", "daily_rank") == [
        (20240101, "one", 2, 1),
        (20240101, "three!", 1, 2),
        (20240101, "two", 1, 2),
        (20240103, "three!", 1, 1),
    ]
    momentum = marts.language_momentum(f, repo, seed)
    assert rows(momentum) == sorted(
        [
            (20240101, "Go", 3, 2, None, 1),
            (20240101, "Unknown", 1, 1, None, 2),
            (20240103, "Go", 1, 1, -2, 2),
            (20240103, "Unknown", 2, 1, 1, 1),
        ],
        key=repr,
    )
    board = marts.contributor_leaderboard(f, actor)
    assert rows(board, "actor_login", "contributions", "daily_rank") == [("zoe", 1, 1)]
    assert marts.enrich_language(f, repo, seed).count() == 7

    page = pages.trending_page(trending, "2024-01-01", limit=2)
    assert [tuple(r) for r in page.collect()] == [
        (20240101, 1, "one", 2, 1),
        (20240101, 3, "three!", 1, 2),
    ]
    rest = pages.trending_page(trending, "2024-01-01", limit=2, offset=2).collect()
    assert [r.repo_id for r in rest] == [2]


def test_page_order_with_ties_and_bounds(spark):
    mart = spark.createDataFrame(
        [(20240101, i, f"r{i}", 42, 1) for i in (99, 101, 7)],
        "date_key bigint, repo_id bigint, repo_name string, stars bigint, daily_rank bigint",
    )
    assert [r.repo_id for r in pages.trending_page(mart, "2024-01-01").collect()] == [101, 99, 7]
    for bad in (
        {"limit": 0},
        {"limit": 101},
        {"offset": -1},
        {"offset": 10_001},
        {"day": "2024-13-01"},
    ):
        with pytest.raises(ValueError):
            pages.trending_page(mart, **{"day": "2024-01-01", **bad})
    assert pages.momentum_page.__defaults__ == (50, 0)
    assert day_to_date_key("2024-01-01") == 20240101


def test_date_key_column(spark):
    df = spark.createDataFrame([(date(2024, 1, 9),), (None,)], "d date")
    assert rows(df.select(date_key("d"))) == [(20240109,), (None,)]
