"""Totals from merged bitmaps against counts over the rows."""

import random

from conftest import rows
from helpers import event, silver_frame

from pyspark.sql import functions as F

from tidemark.operators import bitmaps
from tidemark.sources import silver as silver_io


def silver_of(spark, seed, n=400):
    rng = random.Random(seed)
    ids = [str(rng.randrange(150)), str(10**12 + rng.randrange(60)), f"x{rng.randrange(9)}", "007", "7", "-5", None]
    out = []
    for _ in range(n):
        i = rng.choice([str(rng.randrange(150)), str(10**12 + rng.randrange(60)), f"x{rng.randrange(9)}", *ids])
        out.append(event(i, f"2024-01-0{rng.randint(1, 3)} {rng.randint(0, 3):02d}:00"))
    return silver_frame(spark, out)


def counted(silver, by):
    return silver.groupBy(*by).agg(F.count("*").alias("total_rows"), F.countDistinct("event_id").alias("distinct_event_ids"))


def test_totals_of_any_hours_equal_the_scan(spark, tmp_path):
    silver = silver_of(spark, 1)
    path = str(tmp_path / "bitmaps")
    silver_io.write_bitmaps(silver, path)
    stored = silver_io.read_bitmaps(spark, path)
    for by in (["event_date", "event_hour"], ["event_date"], []):
        assert rows(bitmaps.distinct_ids(stored, by)) == rows(counted(silver, by))
    day = next(iter({r.event_date for r in silver.select("event_date").collect()}))
    some = [(day, 1), (day, 2)]
    part = silver.where((F.col("event_date") == F.lit(day)) & F.col("event_hour").isin(1, 2))
    read = silver_io.read_bitmaps(spark, path, some)
    assert rows(bitmaps.distinct_ids(read)) == rows(counted(part, []))
    assert all(f"event_date={day}" in f for f in read.inputFiles())
    assert "007" in {i for r in stored.where("bucket IS NULL").collect() for i in r.other_ids}


def test_an_hour_written_again_replaces_its_bitmaps(spark, tmp_path):
    path = str(tmp_path / "bitmaps")
    silver = silver_of(spark, 2)
    silver_io.write_bitmaps(silver, path)
    hour = silver.select("event_date", "event_hour").first()
    other = silver_frame(spark, [event("1", f"{hour.event_date} {hour.event_hour:02d}:30")])
    silver_io.write_bitmaps(other, path, [tuple(hour)])
    left = silver.where(~((F.col("event_date") == F.lit(hour.event_date)) & (F.col("event_hour") == hour.event_hour)))
    assert rows(bitmaps.distinct_ids(silver_io.read_bitmaps(spark, path))) == rows(counted(left.unionByName(other), []))
    silver_io.write_bitmaps(other.limit(0), path, [tuple(hour)])
    assert rows(bitmaps.distinct_ids(silver_io.read_bitmaps(spark, path))) == rows(counted(left, []))


def test_repeated_and_empty(spark):
    silver = silver_frame(spark, [event("1", "2024-01-01 05:00"), event("1", "2024-01-01 05:10"), event("2", "2024-01-01 06:00")])
    by = ["event_date", "event_hour"]
    found = bitmaps.repeated(bitmaps.distinct_ids(bitmaps.id_bitmaps(silver), by)).collect()
    assert [(r.event_hour, r.surplus) for r in found] == [(5, 1)]
    nothing = bitmaps.distinct_ids(bitmaps.id_bitmaps(silver.limit(0)))
    assert rows(nothing) == [(0, 0)]
