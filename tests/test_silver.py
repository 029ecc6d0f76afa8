import gzip
from datetime import date, datetime

from conftest import rows
from helpers import raw_frame, raw_row, sourced_frame

from tidemark.operators import silver
from tidemark.sources import bronze as bronze_io
from tidemark.sources import silver as silver_io
from tidemark.schemas import QUARANTINE
from tidemark.sources.tables import list_partitions, read_table

DAY = date(2024, 1, 1)


def test_transform_dedupes_and_nulls_bad_timestamps(spark):
    raw = raw_frame(
        spark,
        [
            raw_row("3", "not-a-timestamp"),
            raw_row("1", "2024-01-01T15:00:00Z"),
            raw_row("2", "2024-01-01T15:30:00Z", "WatchEvent", (2, "bob"), (8, "c/d")),
            raw_row("1", "2024-01-01T15:00:00Z"),
        ],
    )
    out = {r.event_id: r for r in silver.transform_events(raw).collect()}
    assert sorted(out) == ["1", "2", "3"]
    assert out["2"].actor_login == "bob" and out["2"].repo_name == "c/d"
    assert out["2"].created_at == datetime(2024, 1, 1, 15, 30)
    assert (out["2"].event_date, out["2"].event_hour) == (DAY, 15)
    assert (out["3"].created_at, out["3"].event_date, out["3"].event_hour) == (None, None, None)


def test_dedupe_prefers_a_parsable_copy_in_any_order(spark):
    copies = [raw_row("1", "oops"), raw_row("1", "2024-01-01T15:00:00Z", "WatchEvent")]
    for order in (copies, copies[::-1]):
        (kept,) = silver.transform_events(raw_frame(spark, order)).collect()
        assert kept.event_type == "WatchEvent" and kept.created_at is not None


def _bronze(tmp_path, text, day="2024-01-01", hour="05"):
    folder = tmp_path / f"date={day}" / f"hour={hour}"
    folder.mkdir(parents=True)
    with gzip.open(folder / "part.json.gz", "wt") as f:
        f.write(text)
    return str(tmp_path)


LINES = (
    '{"id":"1","type":"PushEvent","public":true,"created_at":"2024-01-01T05:00:00Z",'
    '"actor":{"id":1,"login":"ann"},"repo":{"id":7,"name":"a/b"},"payload":{"email":"x"}}\n'
    "this is no json\n"
    "\n"
    '{"id":"2","type":"PushEvent","public":true,"created_at":"2024-01-01T05:10:00Z",'
    '"actor":{"id":"no number","login":"bob"},"repo":{"id":7,"name":"a/b"}}\n'
    "{also not json\n"
)


def test_bronze_keeps_corrupt_lines_visible(spark, tmp_path):
    root = _bronze(tmp_path, LINES)
    assert bronze_io.read_bronze_lines(spark, root, [(DAY, 5)]).count() == 5
    raw = bronze_io.read_bronze(spark, root, [(DAY, 5)])
    assert "payload" not in raw.columns
    assert raw.where("id IS NULL").count() == 2
    by_id = {r.id: r for r in raw.where("id IS NOT NULL").collect()}
    assert by_id["2"].actor.id is None and by_id["2"].actor.login == "bob"
    assert {(r.source_date, r.source_hour) for r in raw.collect()} == {(DAY, 5)}
    # every corrupt line stays, and its text with it
    kept = silver.transform_events(bronze_io.read_bronze(spark, root, [(DAY, 5)], keep_corrupt=True))
    good, bad = silver.split_quarantine(kept)
    assert good.count() == 2
    assert rows(bad, "raw_text") == [("this is no json",), ("{also not json",)]


def test_copies_are_counted_by_hour_file(spark):
    copies = [raw_row("1", "2024-01-01T05:10:00Z"), raw_row("1", "2024-01-01T05:20:00Z")]
    none = [raw_row(None, "2024-01-01T05:30:00Z")] * 2
    both = sourced_frame(spark, [*copies, *none], DAY, 5).unionByName(sourced_frame(spark, copies, DAY, 6))
    out = silver.transform_events(both)
    kept = rows(out.where("event_id IS NOT NULL"), "source_hour", "created_at")
    assert kept == [(5, datetime(2024, 1, 1, 5, 20)), (6, datetime(2024, 1, 1, 5, 20))]
    good, bad = silver.split_quarantine(out)
    assert good.count() == 2 and bad.count() == 2


def test_landing_skips_hours_already_there(spark, tmp_path):
    root = str(tmp_path / "bronze")
    lines = spark.createDataFrame(
        [("a", DAY, 5), ("b", DAY, 5)], "value string, source_date date, source_hour int"
    )
    bronze_io.land_bronze(lines, root)
    more = spark.createDataFrame([("changed", DAY, 5), ("c", DAY, 16)], lines.schema)
    bronze_io.land_bronze(more, root)
    got = rows(bronze_io.read_bronze_lines(spark, root), "value", "source_hour")
    assert got == [("a", 5), ("b", 5), ("c", 16)]
    assert (tmp_path / "bronze" / "date=2024-01-01" / "hour=05").is_dir()


def test_partition_paths_differ_in_padding():
    assert bronze_io.bronze_partition("2024-01-01", 5) == "date=2024-01-01/hour=05"
    assert silver_io.silver_partition("2024-01-01", 5) == "event_date=2024-01-01/event_hour=5"
    assert silver_io.silver_partition("2024-01-01", 15) == "event_date=2024-01-01/event_hour=15"


def _paths(tmp_path):
    return silver_io.SilverPaths(*[str(tmp_path / n) for n in ("events", "quarantine", "late")])


def _write(spark, paths, hour, raw_rows):
    raw = sourced_frame(spark, raw_rows, DAY, hour)
    return silver_io.write_silver_hours(silver.transform_events(raw), paths, [(DAY, hour)])


H14 = [raw_row("1", "2024-01-01T14:10:00Z"), raw_row("2", "2024-01-01T14:20:00Z")]
H15 = [
    raw_row("3", "2024-01-01T15:00:00Z"),
    raw_row("4", "2024-01-01T14:59:59Z"),  # late: hour 14 in the file of hour 15
    raw_row("5", "bad"),
]


def test_late_rows_survive_any_order_of_runs(spark, tmp_path):
    for name, order in {"a": (14, 15), "b": (15, 14), "c": (14, 15, 14, 15, 15)}.items():
        paths = _paths(tmp_path / name)
        for hour in order:
            touched = _write(spark, paths, hour, {14: H14, 15: H15}[hour])
        got = rows(silver_io.read_silver(spark, paths.events), "event_id", "event_hour")
        assert got == [("1", 14), ("2", 14), ("3", 15), ("4", 14)], name
    assert touched == [(DAY, 14), (DAY, 15)]


def test_quarantine_is_replaced_by_a_clean_rerun(spark, tmp_path):
    paths = _paths(tmp_path)
    _write(spark, paths, 15, H15)
    assert read_table(spark, paths.quarantine, QUARANTINE).count() == 1
    _write(spark, paths, 15, [H15[0]])
    assert read_table(spark, paths.quarantine, QUARANTINE).count() == 0
    assert read_table(spark, paths.late, QUARANTINE).count() == 0


def test_parity_writer_replaces_only_written_hours(spark, tmp_path):
    root = str(tmp_path / "silver")
    first = silver.transform_events(raw_frame(spark, H14 + H15))
    silver_io.write_silver(first, root)
    assert silver_io.read_quarantine(spark, root).count() == 1
    again = silver.transform_events(raw_frame(spark, [raw_row("9", "2024-01-01T15:30:00Z")]))
    silver_io.write_silver(again, root)
    silver_io.write_silver(again, root)
    hour = silver_io.read_silver_hour(spark, root, "2024-01-01", 15)
    assert rows(hour, "event_id") == [("9",)]
    assert silver_io.read_silver_hour(spark, root, "2024-01-01", 14).count() == 3


def test_missing_tables_have_no_rows(spark, tmp_path):
    assert silver_io.read_quarantine(spark, str(tmp_path / "none")).count() == 0
    assert silver_io.read_silver_hour(spark, str(tmp_path / "none"), DAY, 3).count() == 0
    assert list_partitions(spark, str(tmp_path / "none"), ["event_date"]) == set()


def test_load_refuses_nulls_and_foreign_hours_and_leaves_the_table(spark, tmp_path):
    import pytest

    table = str(tmp_path / "t")
    good, _ = silver.split_quarantine(silver.transform_events(raw_frame(spark, H14)))
    silver_io.load_hours(good, table, [(DAY, 14)])
    silver_io.load_hours(good, table, [(DAY, 14)])
    missing = raw_frame(spark, [raw_row("8", "2024-01-01T14:30:00Z", kind=None)])
    foreign = raw_frame(spark, [raw_row("8", "2024-01-01T13:30:00Z")])
    for raw in (missing, foreign):
        with pytest.raises(Exception, match="required column|outside the hours"):
            silver_io.load_hours(silver.transform_events(raw), table, [(DAY, 14)])
    assert silver_io.read_silver(spark, table).count() == 2


def test_corrupt_hour_arguments_are_rejected(spark):
    import pytest

    with pytest.raises(ValueError):
        bronze_io.bronze_partition("2024-01-01", 24)
    with pytest.raises(ValueError):
        silver_io.silver_partition("2024-13-01", 1)
