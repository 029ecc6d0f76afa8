"""Partition swaps that are cut short at every step, and what the next writer or run makes of them."""

from datetime import date

import pytest
from conftest import rows
from helpers import event, silver_frame
from pyspark.sql import Row

from tidemark.operators import fact
from tidemark.operators.silver import stg_events
from tidemark.plans.hourly import finish_pending
from tidemark.plans.lake import Lake
from tidemark.sources import fact as fact_io
from tidemark.sources import silver as silver_io
from tidemark.sources import swaps, tables


class Killed(Exception):
    pass


def frame(spark, data):
    return spark.createDataFrame(data, "v long, day string, hour int")


def read(spark, path):
    return rows(tables.read_table(spark, path, frame(spark, []).schema))


def killing(monkeypatch, renames):
    """Let that many partitions' renames happen, counting both of each, then die."""
    left = [renames]

    def take_place(spark, path, pending, kind, leaf):
        fs, new = tables.file_system(spark, f"{pending}/{kind}/{leaf}")
        place, out = swaps._path(spark, f"{path}/{leaf}"), swaps._path(spark, f"{pending}/out/{leaf}")
        for step in range(2):
            if not left[0]:
                raise Killed
            left[0] -= 1
            if step == 0 and fs.exists(place):
                fs.mkdirs(out.getParent())
                assert fs.rename(place, out)
            if step == 1:
                fs.mkdirs(place.getParent())
                assert fs.rename(new, place) if kind == "rows" else fs.delete(new, True)

    monkeypatch.setattr(swaps, "_take_place", take_place)


@pytest.mark.parametrize("renames", range(7))
def test_a_swap_cut_short_anywhere_is_finished(spark, tmp_path, monkeypatch, renames):
    path = str(tmp_path / "t")
    columns = ["day", "hour"]
    tables.replace_partitions(frame(spark, [(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, "b", 2)]), path, columns)
    new = frame(spark, [(5, "a", 1), (6, "c", 1)])
    expected = [(4, "b", 2), (5, "a", 1), (6, "c", 1)]
    owned = [Row(day="a", hour=2), "day=b/hour=1", Row(day="x", hour=9)]
    expected = sorted(expected, key=repr)
    with monkeypatch.context() as patch:
        killing(patch, renames)
        with pytest.raises(Killed):
            tables.replace_partitions(new, path, columns, owned=owned)
    assert read(spark, path) != expected or renames >= 7
    # the next writer ends it before it does its own work
    changed = tables.replace_partitions(frame(spark, [(7, "d", 1)]), path, columns)
    assert changed == ["day=d/hour=1"]
    assert read(spark, path) == sorted([*expected, (7, "d", 1)], key=repr)
    assert not [f for f in (tmp_path / "t").iterdir() if f.name.startswith("_s") and f.is_dir()]


def test_a_swap_that_was_never_decided_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.replace_partitions(frame(spark, [(1, "a", 1)]), path, ["day", "hour"])
    bad = frame(spark, [(2, "a", 1)]).selectExpr("raise_error('no') v", "day", "hour")
    with pytest.raises(Exception, match="no"):
        tables.replace_partitions(bad, path, ["day", "hour"])
    assert read(spark, path) == [(1, "a", 1)]
    assert swaps.finish_swaps(spark, path, 2) == []
    # what a driver left that died while it wrote
    left = tmp_path / "t" / f"{swaps.WRITING}dead" / "rows" / "day=a" / "hour=1"
    left.mkdir(parents=True)
    assert read(spark, path) == [(1, "a", 1)]
    swaps.finish_swaps(spark, path, 2)
    assert left.exists()
    monkeypatch.setattr(swaps, "ABANDONED_MS", -60_000)
    swaps.finish_swaps(spark, path, 2)
    assert not left.exists() and read(spark, path) == [(1, "a", 1)]


def test_null_partitions_and_reading_the_table_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partitions(frame(spark, [(1, None, 1), (2, "a", 1)]), path, ["day", "hour"])
    again = tables.read_table(spark, path, frame(spark, []).schema).selectExpr("v + 10 v", "day", "hour")
    tables.replace_partitions(again.where("day = 'a'"), path, ["day", "hour"], owned=[Row(day=None, hour=1)])
    assert read(spark, path) == [(12, "a", 1)]


def test_the_next_run_finishes_what_is_pending_in_any_table(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    stg = stg_events(silver_frame(spark, [event("1", "2024-01-01 10:00"), event("2", "2024-01-02 10:00")]))
    path = lake.gold("fact_events")
    fact_io.write_fact(spark, path, fact.fact_events(stg))
    moved = stg_events(silver_frame(spark, [event("1", "2024-01-03 10:00"), event("2", "2024-01-02 11:00")]))
    moved = fact.fact_events(moved)
    replace = fact_io.replace_partitions

    def dying(*args, **kw):
        # the index is written by its own module; this is the fact
        killing(monkeypatch, 3)
        return replace(*args, **kw)

    with monkeypatch.context():
        monkeypatch.setattr(fact_io, "replace_partitions", dying)
        with pytest.raises(Killed):
            fact_io.write_fact(spark, path, moved)
        monkeypatch.undo()
    assert rows(fact_io.read_fact(spark, path)) != rows(moved)
    assert list(finish_pending(spark, lake)) == [path]
    assert rows(fact_io.read_fact(spark, path)) == rows(moved)
    assert finish_pending(spark, lake) == {}


def test_readers_find_the_old_table_while_it_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(frame(spark, [(1, "a", 1)]), path, ["day"])
    (tmp_path / "t").rename(tmp_path / f"t{tables.OLD}")
    schema = frame(spark, []).schema
    assert tables.read_table(spark, path, schema).count() == 1
    assert tables.read_table_folders(spark, path, schema, "day", ["a"]).count() == 1
    assert tables.read_table(spark, str(tmp_path / "other"), schema).count() == 0


def test_a_rerun_empties_what_it_owns_without_reading_it(spark, tmp_path):
    root = tmp_path / "silver"
    paths = silver_io.SilverPaths(f"{root}/events", f"{root}/quarantine", f"{root}/late")
    day = date(2024, 1, 1)
    from helpers import raw_row, sourced_frame

    from tidemark.operators.silver import transform_events

    good = [raw_row("1", "2024-01-01T05:10:00Z"), raw_row("2", "2024-01-01T06:10:00Z"), raw_row("3", "none")]
    silver_io.write_silver_hours(transform_events(sourced_frame(spark, good, day, 5)), paths, [(day, 5)])
    assert silver_io.read_late(spark, paths.late, sent=[(day, 5)]).count() == 1
    silver_io.write_silver_hours(transform_events(sourced_frame(spark, good[:1], day, 5)), paths, [(day, 5)])
    assert silver_io.read_late(spark, paths.late, sent=[(day, 5)]).count() == 0
    assert spark.read.schema("event_id string").parquet(paths.quarantine).count() == 0
    silver_io.write_silver_hours(transform_events(sourced_frame(spark, [], day, 5)), paths, [(day, 5)])
    assert rows(silver_io.read_silver(spark, paths.events), "event_id", "event_hour") == [("2", 6)]
