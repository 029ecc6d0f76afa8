"""Small hand-made frames."""

from datetime import datetime

from pyspark.sql.types import StructType

from tidemark.operators.silver import partition_columns
from tidemark.schemas import ENVELOPE, SILVER, SILVER_COLUMNS

RAW = (
    "id string, type string, public boolean, created_at string, "
    "actor struct<id bigint, login string>, repo struct<id bigint, name string>, "
    "source_date date, source_hour int"
)


def raw_row(event_id, created_at, kind="PushEvent", actor=(1, "ann"), repo=(7, "a/b")):
    return (event_id, kind, True, created_at, actor, repo)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, ENVELOPE)


def sourced_frame(spark, rows, day, hour):
    return spark.createDataFrame([(*r, day, hour) for r in rows], RAW)


def event(event_id, created_at, kind="PushEvent", actor=(1, "ann"), repo=(7, "a/b")):
    when = datetime.fromisoformat(created_at) if created_at else None
    return (event_id, kind, actor[0], actor[1], repo[0], repo[1], True, when)


def silver_frame(spark, rows):
    schema = StructType([f for f in SILVER.fields if f.name in SILVER_COLUMNS])
    return partition_columns(spark.createDataFrame(rows, schema))
