from datetime import datetime

import pytest
from conftest import rows

from tidemark.operators import runs
from tidemark.schemas import RUN_METADATA, RUN_SUMMARY
from tidemark.sources.runs import append_runs, read_runs

START = datetime(2026, 7, 11, 4)
LOGICAL = datetime(2024, 1, 1, 15)
RUN_ID = "backfill__2024-01-01T15:00:00+00:00"


def _runs(spark):
    return spark.createDataFrame(
        [(RUN_ID, START, LOGICAL, datetime(2026, 7, 11, 4, 10))],
        "run_id string, run_start timestamp, logical_date timestamp, recorded_at timestamp",
    )


def _summary(spark, written=datetime(2026, 7, 11, 4, 5), day="2024-01-01", hour=15):
    row = (180387, 180386, 0, 1, True, True, True, True, datetime.fromisoformat(day).date(), hour)
    return spark.createDataFrame([(*row, written)], RUN_SUMMARY)


def _tasks(spark):
    return spark.createDataFrame(
        [(RUN_ID, "ingest", "success", 12.5), (RUN_ID, "build_gold", "failed", None)],
        "run_id string, task_id string, state string, duration double",
    )


def test_row_matches_the_schema_and_keeps_null_durations(spark):
    rows_ = runs.run_rows(_runs(spark), _tasks(spark), _summary(spark))
    assert rows_.columns == RUN_METADATA.fieldNames()
    row = rows_.first()
    counts = (row.raw_rows, row.hour_rows, row.quarantine_rows, row.residual_rows)
    assert counts == (180387, 180386, 0, 1)
    assert [tuple(t) for t in row.tasks] == [
        ("build_gold", "failed", None),
        ("ingest", "success", 12.5),
    ]
    assert row.run_summary_json.pipeline_check is True


@pytest.mark.parametrize(
    "stale",
    [
        {"written": datetime(2026, 7, 11, 3, 59, 59)},
        {"hour": 17},
        {"day": "2024-01-02"},
    ],
)
def test_stale_summary_leaves_nulls_but_records_the_run(spark, stale):
    row = runs.run_rows(_runs(spark), _tasks(spark), _summary(spark, **stale)).first()
    assert row.run_id == RUN_ID and len(row.tasks) == 2
    assert row.raw_rows is None and row.residual_rows is None
    assert row.run_summary_json is None


def test_only_the_last_summary_of_an_hour_counts(spark):
    old = _summary(spark, written=datetime(2026, 7, 11, 4, 1))
    new = _summary(spark, written=datetime(2026, 7, 11, 4, 6))
    fresh = runs.fresh_summaries(_runs(spark), old.unionByName(new))
    assert [r.summary.timestamp for r in fresh.collect()] == [datetime(2026, 7, 11, 4, 6)]


def _meta(spark):
    """Not in output order: an empty run, a good one, one with a nameless task."""
    summary = (180387, 180386, 0, 1, True, True, True, True, LOGICAL.date(), 15, START)
    red = (42, 42, 0, 0, True, True, False, False, LOGICAL.date(), 13, START)
    return spark.createDataFrame(
        [
            ("empty", datetime(2026, 7, 17, 19, 5), LOGICAL, *[None] * 4, None, None),
            (
                "good",
                datetime(2026, 7, 17, 20, 20),
                LOGICAL,
                180387,
                180386,
                0,
                1,
                [("ingest", "success", 0.4), ("build_gold", "success", None)],
                summary,
            ),
            (
                "nameless",
                datetime(2026, 7, 17, 18),
                LOGICAL,
                42,
                42,
                0,
                0,
                [("ingest", "success", 0.4), (None, "success", 1.2)],
                red,
            ),
        ],
        RUN_METADATA,
    )


def test_history_is_newest_first_and_lists_errors_apart(spark):
    history = runs.run_history(_meta(spark)).collect()
    assert [r.run_id for r in history] == ["good", "empty"]
    assert [r.verdict for r in history] == [True, None]
    assert history[1].tasks == [] and history[1].raw_rows is None
    assert [r.run_id for r in runs.run_history(_meta(spark), limit=1).collect()] == ["good"]
    (error,) = runs.run_errors(_meta(spark)).collect()
    assert error.run_id == "nameless" and error.reason
    for limit in (0, 101):
        with pytest.raises(ValueError):
            runs.run_history(_meta(spark), limit=limit)


def test_append_keeps_every_record_and_history_can_take_the_last(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert read_runs(spark, path).count() == 0
    rows_ = runs.run_rows(_runs(spark), _tasks(spark), _summary(spark))
    append_runs(rows_, path)
    append_runs(rows_, path)
    meta = read_runs(spark, path)
    assert meta.count() == 2
    assert rows(runs.run_history(meta, latest_only=True), "run_id") == [(RUN_ID,)]
