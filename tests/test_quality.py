from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from helpers import event, silver_frame
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.schemas import EVENT_TYPES, SILVER_COLUMNS


@pytest.mark.parametrize(
    "raw, hour, bad, expected",
    [(180387, 180386, 0, 1), (180388, 180386, 2, 0)],
)
def test_residual_is_what_is_left(spark, raw, hour, bad, expected):
    df = spark.createDataFrame([(raw, hour, bad)], "r bigint, h bigint, q bigint")
    got = df.select(quality.compute_residual(F.col("r"), F.col("h"), F.col("q"))).first()[0]
    assert got == expected


@pytest.mark.parametrize(
    "residual, raw, ok",
    [
        (1, 180387, True),
        (-5, 180387, False),
        (10, 100000, True),
        (11, 100000, False),
        (100000, 0, False),
        (0, 0, False),
    ],
)
def test_residual_bound(spark, residual, raw, ok):
    df = spark.createDataFrame([(residual, raw)], "x bigint, r bigint")
    assert df.select(quality.residual_ok(F.col("x"), F.col("r"))).first()[0] is ok


@pytest.fixture
def events(spark):
    return silver_frame(
        spark,
        [
            event("1", "2024-01-01 10:00"),
            event("1", "2024-01-01 10:01", "OddEvent"),
            event("2", None, repo=(None, "x")),
            event(None, "2024-01-01 10:02"),
            event(None, "2024-01-01 10:03"),
        ],
    )


def test_row_checks_find_their_failures(spark, events):
    assert rows(quality.not_null(events, ["event_id", "created_at", "event_type"])) == [
        ("created_at", 1),
        ("event_id", 2),
        ("event_type", 0),
    ]
    assert rows(quality.unique(events, "event_id")) == [("1", 2)]
    assert rows(quality.accepted_values(events, "event_type", EVENT_TYPES)) == [("OddEvent", 1)]
    assert quality.accepted_range(events, "event_hour", 11, 12).count() == 4
    assert quality.accepted_range(events, "event_hour", 10, 10).count() == 0
    assert rows(quality.unique_combination(events, ["event_id", "actor_id"])) == [
        ("1", 1, 2),
        (None, 1, 2),
    ]
    parent = spark.createDataFrame([(8,)], "id bigint")
    assert rows(quality.relationships(events, "repo_id", parent, "id")) == [(7, 4)]
    assert quality.relationships(events.where("repo_id IS NULL"), "repo_id", parent, "id").isEmpty()


def test_one_row_checks(spark, events):
    (match,) = quality.columns_match_set(events, SILVER_COLUMNS).collect()
    assert (match.row_count, match.unexpected, match.success) == (5, "event_date,event_hour", False)
    plain = events.select(*reversed(SILVER_COLUMNS))
    assert quality.columns_match_set(plain, SILVER_COLUMNS).first().success
    assert quality.columns_match_set(plain.drop("public"), SILVER_COLUMNS).first().missing == "public"
    rates = {r.column_name: r for r in quality.null_rate(events, ["repo_id", "actor_id"]).collect()}
    assert not rates["repo_id"].success and rates["actor_id"].success
    assert quality.null_rate(events, ["repo_id"], mostly=0.8).first().success
    assert quality.null_rate(events.limit(0), ["repo_id"]).first().success
    assert quality.row_count_between(events, 5, 5).first().success
    assert not quality.row_count_between(events).first().success
    assert not quality.values_unique(events, "event_id").first().success
    assert quality.values_unique(events, "created_at").first().success
    assert quality.quarantine_zero(events.limit(0)).first().success
    assert not quality.quarantine_zero(events).first().success


@pytest.mark.parametrize(
    "hours, status", [(0, "pass"), (12, "pass"), (13, "warn"), (24, "warn"), (25, "error")]
)
def test_freshness(spark, hours, status):
    df = silver_frame(spark, [event("1", "2024-01-01 00:00"), event("2", "2024-01-01 10:00")])
    as_of = datetime(2024, 1, 1, 10) + timedelta(hours=hours)
    assert quality.freshness(df, "created_at", as_of).first().status == status
    assert quality.freshness(df.limit(0), "created_at", as_of).first().status == "error"


DAY = date(2024, 1, 1)
NOW = datetime(2024, 1, 2)
BOUNDS = quality.SuiteBounds(min_rows=1)
SOURCE = "event_id string, source_date date, source_hour int"


def _inputs(spark, extra_raw=0, bad=0, silver_rows=None):
    silver = silver_frame(
        spark,
        silver_rows or [event("1", "2024-01-01 10:00"), event("2", "2024-01-01 11:00")],
    )
    raw_rows = [("1", DAY, 10), ("2", DAY, 11), *[("x", DAY, 10)] * extra_raw]
    bad_rows = [("b", DAY, 10)] * bad
    raw = spark.createDataFrame([*raw_rows, *bad_rows], SOURCE)
    return raw, silver, spark.createDataFrame(bad_rows, SOURCE)


def _by_hour(verdict):
    return {r.partition_hour: r for r in verdict.collect()}


def test_green_verdict_opens_the_gate(spark):
    verdict = quality.suite_verdict(*_inputs(spark), NOW, BOUNDS)
    got = _by_hour(verdict)
    assert got[10].pipeline_check and got[11].pipeline_check
    assert (got[10].raw_rows, got[10].hour_rows, got[10].residual_rows) == (1, 1, 0)
    quality.gate(verdict)


def test_quarantine_scopes(spark):
    inputs = _inputs(spark, bad=1)
    by_hour = _by_hour(quality.suite_verdict(*inputs, NOW, BOUNDS))
    assert not by_hour[10].quarantine_check and by_hour[11].pipeline_check
    by_table = _by_hour(quality.suite_verdict(*inputs, NOW, BOUNDS, quarantine_scope="table"))
    assert not by_table[11].quarantine_check and by_table[11].residual_rows == -1
    with pytest.raises(ValueError):
        quality.suite_verdict(*inputs, NOW, BOUNDS, quarantine_scope="day")


@pytest.mark.parametrize(
    "kwargs, check",
    [
        ({"bad": 1}, "quarantine_check"),
        ({"extra_raw": 1}, "residual_check"),
        (
            {"silver_rows": [event("1", "2024-01-01 10:00")] * 2},
            "great_expectations_suite_check",
        ),
        (
            {"silver_rows": [event("1", "2024-01-01 10:00", kind=None)]},
            "great_expectations_suite_check",
        ),
        (
            {"silver_rows": [event("1", "2024-01-01 10:00", repo=(None, None))]},
            "great_expectations_suite_check",
        ),
    ],
)
def test_red_verdict_closes_the_gate(spark, kwargs, check):
    verdict = quality.suite_verdict(*_inputs(spark, **kwargs), NOW, BOUNDS)
    assert not _by_hour(verdict)[10][check]
    with pytest.raises(quality.QualityGateError, match="2024-01-01 10h"):
        quality.gate(verdict)


def test_suite_sees_drifted_columns_and_small_hours(spark):
    raw, silver, bad = _inputs(spark)
    drifted = quality.suite_verdict(raw, silver.withColumn("x", F.lit(1)), bad, NOW, BOUNDS)
    assert not _by_hour(drifted)[10].great_expectations_suite_check
    assert not _by_hour(quality.suite_verdict(raw, silver, bad, NOW))[10].pipeline_check


def test_late_rows_balance_for_both_hours(spark):
    raw, silver, bad = _inputs(
        spark,
        silver_rows=[
            event("1", "2024-01-01 10:00"),
            event("2", "2024-01-01 10:59"),
        ],
    )
    late = spark.createDataFrame(
        [("2", DAY, 11, DAY, 10)],
        "event_id string, source_date date, source_hour int, event_date date, event_hour int",
    )
    got = _by_hour(quality.suite_verdict(raw, silver, bad, NOW, BOUNDS, late=late))
    assert got[10].residual_rows == 0 and got[11].residual_rows == 0


def test_whole_table_residual(spark):
    raw, silver, bad = _inputs(spark, extra_raw=1, bad=2)
    (row,) = quality.residual(raw, silver, bad, threshold=0.5).collect()
    assert tuple(row) == (5, 2, 2, 1, True)
