"""Hours as (day, hour) pairs and predicates on the columns that hold them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.keys import check_hour, parse_day

Hour = tuple[date, int]


def as_hour(day: str | date, hour: int) -> Hour:
    return parse_day(day), check_hour(hour)


def hour_range(first: datetime, end: datetime) -> list[Hour]:
    """Every hour from ``first`` up to, not including, ``end``."""
    count = int((end - first) / timedelta(hours=1))
    starts = (first + timedelta(hours=i) for i in range(count))
    return [as_hour(start.date(), start.hour) for start in starts]


def days_of(hours: Iterable[Hour]) -> set[date]:
    return {day for day, _ in hours}


def in_hours(hours: Iterable[Hour], columns: Sequence[str]) -> Column:
    """Predicate on a day and an hour column, one term per day."""
    per_day: dict[date, list[int]] = {}
    for day, hour in hours:
        per_day.setdefault(day, []).append(hour)
    condition = F.lit(False)
    for day, of_day in sorted(per_day.items()):
        condition = condition | (
            (F.col(columns[0]) == F.lit(day)) & F.col(columns[1]).isin(sorted(of_day))
        )
    return condition
