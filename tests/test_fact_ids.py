"""The id index: pruned lookups, and an upsert that finds ids on other days through it."""

from datetime import date

import pytest
from conftest import rows
from helpers import event, silver_frame

from tidemark.operators import fact
from tidemark.operators.silver import stg_events
from tidemark.sources import fact as fact_io
from tidemark.sources import fact_ids


def events_of(spark, some):
    return fact.fact_events(stg_events(silver_frame(spark, [event(i, at) for i, at in some])))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(fact_ids, "BLOCK_IDS", 100)


@pytest.fixture
def stored(spark, tmp_path, small_blocks):
    path = str(tmp_path / "fact")
    some = [(str(i), f"2024-01-{1 + i // 100:02d} 10:00") for i in range(900)]
    fact_io.write_fact(spark, path, events_of(spark, [*some, ("odd", "2024-01-01 09:00")]), full_refresh=True)
    return path


def folders_of(frame):
    return {name.split("id_block=")[1].split("/")[0] for name in frame.inputFiles()}


def test_blocks_are_ranges_of_numbers_and_hashes_of_the_rest(spark, small_blocks):
    ids = [("0",), ("99",), ("100",), ("-1",), ("x1",), ("99999999999999999999",), (None,)]
    df = spark.createDataFrame(ids, "event_id string")
    got = dict(df.select("event_id", fact_ids.id_block()).collect())
    assert [got[i] for i in ("0", "99", "100", "-1")] == ["n0", "n0", "n1", "n-1"]
    assert got["x1"].startswith("h") and got["99999999999999999999"].startswith("h")


def test_a_lookup_reads_only_the_blocks_of_the_incoming_ids(spark, stored):
    index = fact_ids.ids_path(stored)
    pairs = fact_ids.pairs_of(events_of(spark, [("150", "2024-01-09 10:00"), ("odd", "2024-01-09 10:00")]))
    blocks = fact_ids.blocks_of(pairs)
    found = fact_ids.known_days(spark, index, pairs, blocks)
    assert folders_of(fact_ids.read_blocks(spark, index, blocks)) == set(blocks) and len(blocks) == 2
    assert len(folders_of(fact_ids.read_blocks(spark, index, [f"n{i}" for i in range(9)]))) == 9
    assert rows(found) == [("150", date(2024, 1, 2)), ("odd", date(2024, 1, 1))]
    # the fact itself is read for the touched days alone
    text = fact_io.read_fact_days(spark, stored, [date(2024, 1, 2)]).inputFiles()
    assert all("event_date=2024-01-02" in name for name in text)


def test_an_id_on_two_days_is_one_row(spark, stored):
    later = events_of(spark, [("150", "2024-01-09 11:00"), ("odd", "2024-01-08 11:00"), ("950", "2024-01-05 10:00")])
    days = fact_io.write_fact(spark, stored, later)
    assert sorted(d.day for d in days) == [1, 2, 5, 8, 9]
    earlier = events_of(spark, [("151", "2024-01-01 01:00")])
    assert sorted(d.day for d in fact_io.write_fact(spark, stored, earlier)) == [1, 2]
    loaded = fact_io.read_fact(spark, stored)
    assert loaded.count() == 902 and loaded.select("event_id").distinct().count() == 902
    where = dict(loaded.where("event_id IN ('150', '151', 'odd', '950')").select("event_id", "date_key").collect())
    assert where == {"150": 20240109, "151": 20240102, "odd": 20240108, "950": 20240105}


def test_only_blocks_with_new_pairs_are_rewritten(spark, stored, tmp_path):
    index = fact_ids.ids_path(stored)

    def files():
        return {str(f.relative_to(tmp_path)) for f in (tmp_path / "fact_ids").rglob("*.parquet")}

    before = files()
    known = fact_ids.pairs_of(events_of(spark, [("5", "2024-01-01 10:00"), ("205", "2024-01-03 10:00")]))
    assert fact_ids.add_pairs(spark, index, known, fact_ids.blocks_of(known)) == []
    assert files() == before
    new = fact_ids.pairs_of(events_of(spark, [("5", "2024-01-04 10:00"), ("205", "2024-01-03 10:00")]))
    assert fact_ids.add_pairs(spark, index, new, fact_ids.blocks_of(new)) == ["n0"]
    gone = before - files()
    assert gone and all("id_block=n0/" in f for f in gone)


def test_a_fact_without_an_index_gets_one(spark, stored):
    index = fact_ids.ids_path(stored)
    whole = rows(fact_ids.read_blocks(spark, index, [f"n{i}" for i in range(9)]))
    fact_ids.drop_index(spark, index)
    fact_io.write_fact(spark, stored, events_of(spark, [("150", "2024-01-09 11:00")]))
    assert fact_io.read_fact(spark, stored).where("event_id = '150'").count() == 1
    now = rows(fact_ids.read_blocks(spark, index, [f"n{i}" for i in range(9)]))
    assert set(whole) < set(now) and len(now) == len(whole) + 1


def test_without_moving_events_no_other_day_is_looked_for(spark, stored):
    again = events_of(spark, [("150", "2024-01-09 11:00")])
    assert fact_io.write_fact(spark, stored, again, events_may_move=False) == [date(2024, 1, 9)]
