from datetime import date, datetime

import pytest
from conftest import rows
from helpers import raw_row, sourced_frame
from pyspark.sql import functions as F

from tidemark.operators import dims, fact, marts
from tidemark.operators.quality import QualityGateError, SuiteBounds
from tidemark.operators.runs import run_history
from tidemark.operators.silver import stg_events
from tidemark.functions.hours import hour_range
from tidemark.plans import gold, hourly
from tidemark.plans.model_tests import MODEL_TESTS, ModelTestError, require_passing
from tidemark.plans.lake import Lake
from tidemark.sources.bronze import land_bronze
from tidemark.sources.fact import read_fact
from tidemark.schemas import MARTS, QUARANTINE
from tidemark.sources.runs import read_runs
from tidemark.sources.silver import read_silver
from tidemark.sources.tables import read_mart, read_table

DAY = date(2024, 1, 1)
BOUNDS = SuiteBounds(min_rows=1, residual_threshold=0.3)
KINDS = ["WatchEvent", "PushEvent", "ForkEvent"]


def _hour_rows(hour, n=12):
    out = [
        raw_row(
            f"{hour}-{i}",
            f"2024-01-01T{hour:02d}:{i:02d}:00Z",
            KINDS[i % 3],
            (i % 4, f"actor{i % 4}-{hour}"),
            (i % 5, f"repo{i % 5}-{hour}"),
        )
        for i in range(n)
    ]
    return [*out, out[0]]


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(str(tmp_path))
    seed = spark.createDataFrame([(0, "Go"), (1, "Rust")], "repo_id bigint, language string")
    seed.coalesce(1).write.option("header", True).csv(lake.seed)
    return lake


def _land(spark, lake, hour, raw_rows):
    fields = ["id", "type", "public", "created_at", "actor", "repo"]
    raw = sourced_frame(spark, raw_rows, DAY, hour)
    lines = raw.select(F.to_json(F.struct(*fields)).alias("value"), "source_date", "source_hour")
    land_bronze(lines, lake.bronze)


TABLES = [
    "dim_repo",
    "dim_actor",
    "dim_event_type",
    "fact_events",
    "trending_repos_daily",
    "language_momentum",
    "contributor_leaderboard",
]


def _gold(spark, lake):
    marts_of = {t: read_mart(spark, lake.gold(t), MARTS[t]) for t in TABLES if t in MARTS}
    return {t: rows(marts_of.get(t) or spark.read.parquet(lake.gold(t))) for t in TABLES}


def test_hours_one_by_one_in_any_order_equal_one_backfill(spark, tmp_path, lake):
    late = raw_row("late", "2024-01-01T13:59:59Z", "PushEvent", (9, "zoe"), (9, "late/repo"))
    hours = {13: _hour_rows(13), 14: [*_hour_rows(14), late]}
    for hour in (14, 13, 14):
        _land(spark, lake, hour, hours[hour])
        hourly.run_hours(spark, lake, [(DAY, hour)], bounds=BOUNDS)
    first = _gold(spark, lake)
    assert len(first["fact_events"]) == 25
    assert rows(hourly.loaded_totals(spark, lake)) == rows(hourly.loaded_totals(spark, lake, [(DAY, 13), (DAY, 14)])) == [(25, 25)]
    assert all(r.success for r in gold.reconcile(spark, lake).collect())
    # going from the watermark instead of the named hours finds nothing new
    gold.refresh_gold(spark, lake)
    assert _gold(spark, lake) == first

    other = Lake(str(tmp_path / "other"))
    seed = spark.read.option("header", True).csv(lake.seed)
    seed.write.option("header", True).csv(other.seed)
    for hour, raw_rows in hours.items():
        _land(spark, other, hour, raw_rows)
    wanted = hour_range(datetime(2024, 1, 1, 13), datetime(2024, 1, 1, 15))
    hourly.run_hours(spark, other, wanted, kind="backfill", bounds=BOUNDS, full_refresh=True)
    assert _gold(spark, other) == first

    # the same as the plain functions over the whole silver table
    stg = stg_events(read_silver(spark, other.silver_events))
    f, repo = fact.fact_events(stg), dims.dim_repo(stg)
    trending = marts.trending_repos_daily(f, repo).select(
        "repo_sk", "repo_id", "repo_name", "stars", "daily_rank", "date_key"
    )
    assert rows(trending) == first["trending_repos_daily"]
    assert rows(read_fact(spark, other.gold("fact_events"))) == rows(f)

    history = run_history(read_runs(spark, lake.runs), limit=100).collect()
    assert len(history) == 3 and all(r.verdict for r in history)
    assert history[0].run_id == "scheduled__2024-01-01T14:00:00+00:00"
    assert {t.task_id for t in history[0].tasks} == {
        "silver_transform",
        "validate_silver",
        "load_silver",
        "build_gold",
    }


def test_red_gate_stops_the_run_and_is_recorded(spark, lake):
    _land(spark, lake, 13, [*_hour_rows(13), raw_row("bad", "no time")])
    with pytest.raises(QualityGateError):
        hourly.run_hours(spark, lake, [(DAY, 13)], bounds=BOUNDS)
    assert read_silver(spark, lake.silver_events).count() == 0
    (run,) = run_history(read_runs(spark, lake.runs)).collect()
    assert run.verdict is False and run.quarantine_rows == 1
    states = {t.task_id: t.state for t in run.tasks}
    assert states == {
        "silver_transform": "success",
        "validate_silver": "failed",
        "load_silver": "upstream_failed",
        "build_gold": "upstream_failed",
    }


def test_missing_hour_is_recorded_without_counts(spark, lake):
    with pytest.raises(Exception):
        hourly.run_hours(spark, lake, [(DAY, 3)], bounds=BOUNDS)
    (run,) = run_history(read_runs(spark, lake.runs)).collect()
    assert run.raw_rows is None and run.verdict is None


def test_a_red_hour_does_not_hold_up_the_others(spark, lake):
    _land(spark, lake, 13, _hour_rows(13))
    late = raw_row("late", "2024-01-01T14:00:00Z")
    _land(spark, lake, 14, [*_hour_rows(14), raw_row("bad", "no time")])
    _land(spark, lake, 15, [*_hour_rows(15), late])
    with pytest.raises(QualityGateError, match="14h"):
        hourly.run_hours(spark, lake, [(DAY, 13), (DAY, 14), (DAY, 16)], bounds=BOUNDS)
    loaded = read_silver(spark, lake.silver_events)
    assert rows(loaded.select("event_hour").distinct()) == [(13,)]
    # a late row for the stopped hour does not carry it past the gate
    hourly.run_hours(spark, lake, [(DAY, 15)], bounds=BOUNDS)
    loaded = read_silver(spark, lake.silver_events)
    assert rows(loaded.select("event_hour").distinct()) == [(13,), (15,)]
    history = run_history(read_runs(spark, lake.runs), limit=100).collect()
    verdicts = {r.run_id[22:24]: r.verdict for r in history}
    assert verdicts == {"13": True, "14": False, "15": True, "16": None}


def _land_text(spark, lake, hour, good, bad_lines, day=DAY):
    fields = ["id", "type", "public", "created_at", "actor", "repo"]
    raw = sourced_frame(spark, good, day, hour)
    lines = raw.select(F.to_json(F.struct(*fields)).alias("value"), "source_date", "source_hour")
    bad = spark.createDataFrame([(x, day, hour) for x in bad_lines], lines.schema)
    land_bronze(lines.unionByName(bad), lake.bronze)


def _ran(spark, lake, calls):
    for hours in calls:
        try:
            hourly.run_hours(spark, lake, hours, bounds=BOUNDS)
        except QualityGateError:
            pass
    history = run_history(read_runs(spark, lake.runs), limit=100).collect()
    verdicts = {r.run_id: (r.verdict, r.hour_rows, r.quarantine_rows, r.residual_rows) for r in history}
    silver = rows(read_silver(spark, lake.silver.events))
    quarantine = rows(
        read_table(spark, lake.silver.quarantine, QUARANTINE), "source_hour", "raw_text"
    )
    return verdicts, silver, quarantine


def test_corrupt_lines_turn_every_hour_red_however_it_is_run(spark, tmp_path):
    ran = []
    for name, calls in {"one": [[(DAY, 1)], [(DAY, 2)]], "all": [[(DAY, 1), (DAY, 2)]]}.items():
        lake = Lake(str(tmp_path / name))
        for hour in (1, 2):
            _land_text(spark, lake, hour, _hour_rows(hour, 8)[:8], ["no json", "none either"])
        ran.append(_ran(spark, lake, calls))
    assert ran[0] == ran[1]
    verdicts, _, quarantine = ran[0]
    assert all(v[0] is False and v[2] == 2 and v[3] == 0 for v in verdicts.values())
    assert quarantine == sorted([(h, t) for h in (1, 2) for t in ("no json", "none either")], key=repr)


def test_an_event_on_two_days_is_one_row_of_the_fact(spark, tmp_path):
    next_day = date(2024, 1, 2)
    twice = {
        (DAY, 23): raw_row("X", "2024-01-01T23:30:00Z", "PushEvent", (1, "ann"), (7, "a/b")),
        (next_day, 0): raw_row("X", "2024-01-02T00:10:00Z", "PushEvent", (1, "ann"), (7, "a/b")),
    }
    gold_of = []
    orders = {"on": [[h] for h in twice], "back": [[h] for h in reversed(twice)], "all": [list(twice)]}
    for name, calls in orders.items():
        lake = Lake(str(tmp_path / name))
        seed = spark.createDataFrame([(0, "Go")], "repo_id bigint, language string")
        seed.coalesce(1).write.option("header", True).csv(lake.seed)
        for (day, hour), row in twice.items():
            own = raw_row(f"{day}-{hour}", f"{day}T{hour:02d}:00:00Z")
            _land_text(spark, lake, hour, [own, row], [], day)
        verdicts, _, _ = _ran(spark, lake, calls)
        assert all(v[0] for v in verdicts.values()), name
        gold_of.append(_gold(spark, lake))
        events = read_fact(spark, lake.gold("fact_events"))
        assert rows(events.where("event_id = 'X'"), "event_date") == [(next_day,)], name
    assert gold_of[0] == gold_of[1] == gold_of[2]


def test_an_event_outside_the_calendar_fails(spark, lake):
    late_year = Lake(lake.root, "2023-01-01", "2024-01-01")
    _land(spark, lake, 13, _hour_rows(13))
    with pytest.raises(ModelTestError, match="relationships"):
        hourly.run_hours(spark, late_year, [(DAY, 13)], bounds=BOUNDS)
    assert dims.dim_date(spark).count() == 366


def test_model_tests_are_all_declared_and_can_fail(spark):
    count = sum(
        len(t.not_null)
        + len(t.unique)
        + bool(t.unique_combination)
        + len(t.accepted_values)
        + len(t.accepted_range)
        + len(t.relationships)
        for t in MODEL_TESTS.values()
    )
    assert count == 59
    types = spark.createDataFrame([("PushEvent",), ("OddEvent",), (None,)], "event_type string")
    with pytest.raises(ModelTestError, match="not_null.*accepted_values"):
        require_passing({"dim_event_type": types})
    require_passing({"dim_event_type": types.where("event_type = 'PushEvent'")})
    twice = spark.createDataFrame([(1, "Go"), (1, "C")], "repo_id bigint, language string")
    with pytest.raises(ModelTestError, match=r"unique\(repo_id\): 1"):
        require_passing({"repo_languages": twice})


def test_stream_runs_each_landed_hour_once(spark, lake, tmp_path):
    from tidemark.streaming.hours import run_landed_hours

    def drain():
        query = run_landed_hours(spark, lake, str(tmp_path / "stream"), BOUNDS, files_per_batch=2)
        query.awaitTermination(240)
        assert query.exception() is None

    _land(spark, lake, 13, _hour_rows(13))
    _land(spark, lake, 14, [*_hour_rows(14), raw_row("bad", "no time")])
    drain()
    _land(spark, lake, 15, _hour_rows(15))
    drain()
    drain()
    history = run_history(read_runs(spark, lake.runs), limit=100).collect()
    assert sorted((r.run_id[22:24], r.verdict) for r in history) == [
        ("13", True),
        ("14", False),
        ("15", True),
    ]
    assert read_fact(spark, lake.gold("fact_events")).count() == 24
