"""The stateful stream against the batch over the same files."""

from datetime import date

from conftest import rows
from helpers import raw_row, sourced_frame

from pyspark.sql import functions as F

from tidemark.operators.silver import transform_events
from tidemark.sources.bronze import land_bronze, read_bronze
from tidemark.streaming.silver import stream_silver

DAY = date(2024, 1, 1)


def land(spark, root, hour, raw):
    lines = sourced_frame(spark, raw, DAY, hour).select(
        F.to_json(F.struct("id", "type", "public", "created_at", "actor", "repo")).alias("value"), "source_date", "source_hour"
    )
    land_bronze(lines.repartition(3), root)


def hour_rows(hour):
    out = [raw_row(f"{hour}-{i}", f"2024-01-01T{hour:02d}:{i:02d}:00Z", "PushEvent", (i, f"a{i}")) for i in range(20)]
    # copies: exact, later under another login, without a time, and of an event of the hour before
    out += [out[0], raw_row(f"{hour}-1", f"2024-01-01T{hour:02d}:59:00Z", "PushEvent", (1, "late")), raw_row(f"{hour}-2", "none")]
    return [*out, raw_row(f"{hour - 1}-3", f"2024-01-01T{hour:02d}:30:00Z"), raw_row(None, f"2024-01-01T{hour:02d}:31:00Z")]


def test_the_stream_equals_the_batch(spark, tmp_path):
    bronze, silver, checkpoint = (str(tmp_path / name) for name in ("bronze", "silver", "checkpoint"))

    def drain():
        query = stream_silver(spark, bronze, silver, checkpoint, files_per_batch=2)
        query.awaitTermination(240)
        assert query.exception() is None

    def streamed():
        return spark.read.parquet(silver)

    def batch(hours):
        whole = transform_events(read_bronze(spark, bronze)).where("event_id IS NOT NULL")
        return whole.where(F.col("source_hour").isin(hours))

    for hour in (5, 6):
        land(spark, bronze, hour, hour_rows(hour))
    drain()
    land(spark, bronze, 9, hour_rows(9))
    drain()
    names = batch([5]).columns
    # 5 and 6 are more than two hours older than 9, which itself is still held
    assert rows(streamed(), *names) == rows(batch([5, 6]), *names)
    for hour in (8, 13):
        land(spark, bronze, hour, hour_rows(hour))
    drain()
    drain()
    assert rows(streamed(), *names) == rows(batch([5, 6, 8, 9]), *names)
    # 7 comes after all of it and is late
    land(spark, bronze, 7, hour_rows(7))
    land(spark, bronze, 17, hour_rows(17))
    drain()
    assert rows(streamed(), *names) == rows(batch([5, 6, 8, 9, 13]), *names)
