"""Key and day expressions shared by the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a missing key part is hashed as.
MISSING_KEY_PART = "_dbt_utils_surrogate_key_null_"
# Fixed value: the bucket for repositories without a known language.
UNKNOWN_LANGUAGE = "Unknown"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 hex over the key columns, joined by '-'; a NULL part still gives a key that joins."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit(MISSING_KEY_PART)) for p in parts]
    return F.md5(texts[0] if len(texts) == 1 else F.concat_ws("-", *texts))


def date_key(day: str | Column) -> Column:
    """YYYYMMDD as a bigint."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def default_unknown(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(UNKNOWN_LANGUAGE))


def parse_day(day: str | date) -> date:
    """A calendar day from ISO text; raises ValueError before any job starts."""
    return day if isinstance(day, date) else date.fromisoformat(day)


def day_to_date_key(day: str | date) -> int:
    return int(parse_day(day).strftime("%Y%m%d"))


def check_hour(hour: int) -> int:
    if not 0 <= hour <= 23:
        raise ValueError(f"hour must be 0..23, got {hour}")
    return hour


def bronze_partition_path(day: Column, hour: Column) -> Column:
    """Partition folder of an hour in bronze, where the hour has two digits."""
    return F.concat(
        F.lit("date="), F.date_format(day, "yyyy-MM-dd"), F.lit("/hour="), F.lpad(hour, 2, "0")
    )


def silver_partition_path(day: Column, hour: Column) -> Column:
    """Partition folder of an hour in silver, where the hour is not padded."""
    return F.concat(
        F.lit("event_date="), F.date_format(day, "yyyy-MM-dd"), F.lit("/event_hour="), hour
    )


def hour_key(day: Column, hour: Column) -> Column:
    """YYYYMMDDHH text, the name of an hour's partition in the warehouse table."""
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lpad(hour, 2, "0"))
