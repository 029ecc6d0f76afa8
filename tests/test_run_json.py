"""Run records where a field is absent, NULL or a value; the run table by day."""

from datetime import datetime

import pytest
from conftest import rows

from tidemark.operators import run_json, runs
from tidemark.schemas import RUN_METADATA, RUN_RECORDS
from tidemark.sources import runs as runs_io
from tidemark.sources.tables import read_table

AT = datetime(2024, 1, 1, 15)


def records(spark, texts):
    """{run_id: tasks} as they were logged."""
    data = [(i, AT.replace(minute=at), AT, 9, 8, 0, 1, t, '{"pipeline_check": true}') for at, (i, t) in enumerate(texts)]
    schema = (
        "run_id string, recorded_at timestamp, logical_date timestamp, raw_rows long, hour_rows long, "
        "quarantine_rows long, residual_rows long, tasks_json string, summary_json string"
    )
    columns = {"tasks": "tasks_json", "run_summary_json": "summary_json"}
    return run_json.parse_records(spark.createDataFrame(data, schema), columns)


TASK = '{"task_id": "a", "state": "success"%s}'
CASES = {
    "absent": (f"[{TASK % ''}]", "tasks[0].duration is absent"),
    "null": (f"[{TASK % ', \"duration\": null'}]", None),
    "value": (f"[{TASK % ', \"duration\": 2.5'}]", None),
    "whole": (f"[{TASK % ', \"duration\": 3'}]", None),
    "text": (f"[{TASK % ', \"duration\": \"soon\"'}]", "tasks[0].duration is invalid"),
    "second": (f"[{TASK % ', \"duration\": 1'}, {TASK % ''}]", "tasks[1].duration is absent"),
    "nameless": ('[{"state": "success", "duration": 1}]', "tasks[0].task_id is absent"),
    "null state": ('[{"task_id": "a", "state": null, "duration": 1}]', "tasks[0].state is null"),
    "number as id": ('[{"task_id": 5, "state": "s", "duration": 1}]', "tasks[0].task_id is invalid"),
    "no list": ('{"task_id": "a"}', "tasks is no list"),
    "no json": ("[{", "tasks is no list"),
    "empty": ("[]", None),
    "json null": ("null", None),
    "none": (None, None),
}


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "records")
    runs_io.append_run_records(records(spark, [(name, text) for name, (text, _) in CASES.items()]), path)
    return runs_io.read_run_records(spark, path)


def test_absent_null_and_value_differ(spark, stored):
    got = {r.run_id: (r.duration_kind, r.duration) for r in run_json.task_durations(stored).where("pos = 0").collect()}
    assert got["absent"] == ("absent", None)
    assert got["null"] == ("null", None)
    assert got["value"] == ("value", 2.5) and got["whole"] == ("value", 3.0)
    assert got["text"] == ("invalid", None)
    assert not got.keys() & {"no list", "no json", "empty", "json null", "none"}


def test_errors_name_the_first_thing_that_is_wrong(spark, stored):
    assert stored.columns == RUN_RECORDS.fieldNames()
    expected = {name: reason for name, (_, reason) in CASES.items() if reason}
    assert dict(run_json.run_errors(stored).collect()) == expected


def test_history_has_the_others_newest_first(spark, stored):
    history = run_json.run_history(stored, limit=100).collect()
    good = [name for name, (_, reason) in CASES.items() if not reason]
    assert [r.run_id for r in history] == list(reversed(good))
    tasks = {r.run_id: [tuple(t) for t in r.tasks] for r in history}
    assert tasks["null"] == [("a", "success", None)] and tasks["value"] == [("a", "success", 2.5)]
    assert tasks["none"] == tasks["json null"] == tasks["empty"] == []
    assert all(r.verdict is True and r.raw_rows == 9 for r in history)
    for limit in (0, 101):
        with pytest.raises(ValueError):
            run_json.run_history(stored, limit)


@pytest.mark.parametrize("summary, expected", [('{"pipeline_check": null}', None), ("{}", None), (None, None), ('{"pipeline_check": false}', False)])
def test_verdict(spark, summary, expected):
    df = run_json.parse_records(spark.createDataFrame([("r", summary)], "run_id string, s string"), {"v": "s"})
    assert df.select(run_json.verdict(df.v)).first()[0] is expected


def meta(spark, data):
    """(run_id, recorded_at, well-formed)."""
    made = [
        (i, at, AT, 1, 1, 0, 0, [("t", "success" if good else None, None)], None) for i, at, good in data
    ]
    return spark.createDataFrame(made, RUN_METADATA)


def on(day, hour=0):
    return datetime(2024, 1, day, hour)


def test_a_repeated_write_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = meta(spark, [("a", on(1), True), ("b", on(1, 5), True), ("c", on(2), True)])
    assert runs_io.record_runs(first, path) == 3
    assert runs_io.record_runs(first, path) == 0
    # run again, and one lost between two of its rows
    assert runs_io.record_runs(meta(spark, [("a", on(3), True), ("c", on(2), True), ("d", on(2), True)]), path) == 2
    got = rows(runs_io.read_runs(spark, path), "run_id", "recorded_at")
    assert got == sorted([("a", on(1)), ("a", on(3)), ("b", on(1, 5)), ("c", on(2)), ("d", on(2))], key=repr)
    assert runs_io.read_runs(spark, path).columns == RUN_METADATA.fieldNames()


def test_only_the_days_that_grow_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs_io.record_runs(meta(spark, [("a", on(1), True), ("b", on(2), True)]), path)

    def files():
        return {str(f) for f in (tmp_path / "runs").rglob("*.parquet")}

    before = files()
    runs_io.record_runs(meta(spark, [("a", on(1), True), ("c", on(2), True)]), path)
    gone = before - files()
    assert gone and all("run_day=2024-01-02" in f for f in gone)


def test_history_reads_the_newest_days_it_needs(spark, tmp_path):
    path = str(tmp_path / "runs")
    data = [(f"{d}-{h}", on(d, h), h != 3) for d in range(1, 10) for h in range(4)]
    runs_io.record_runs(meta(spark, data), path)

    def days(df):
        return {f.split("run_day=")[1][:10] for f in df.inputFiles()}

    one = runs_io.recent_runs(spark, path, limit=3)
    assert days(one) == {"2024-01-09"} and [r.run_id for r in one.collect()] == ["9-2", "9-1", "9-0"]
    # a malformed run does not count, so three days hold nine
    some = runs_io.recent_runs(spark, path, limit=7)
    assert days(some) == {f"2024-01-0{d}" for d in (6, 7, 8, 9)}
    whole = runs.run_history(runs_io.read_runs(spark, path), limit=100)
    assert runs_io.recent_runs(spark, path, limit=100).collect() == whole.collect()
    assert some.collect() == whole.limit(7).collect()
    assert runs_io.recent_runs(spark, str(tmp_path / "none")).count() == 0


def test_a_table_without_days_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "runs")
    old = meta(spark, [("a", on(1), True), ("b", on(2), True)])
    old.write.parquet(path)
    assert runs_io.record_runs(meta(spark, [("b", on(2), True), ("c", on(3), True)]), path) == 1
    assert rows(runs_io.read_runs(spark, path), "run_id") == [("a",), ("b",), ("c",)]
    assert read_table(spark, path, runs_io._by_day(RUN_METADATA)).select("run_day").distinct().count() == 3
