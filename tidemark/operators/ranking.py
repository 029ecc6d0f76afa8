"""Rank within a day without gathering the day in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that share a small value are spread over this many join keys.
TIE_SPREAD = 64


def _salts(value: str) -> Column:
    return F.ceil(F.lit(TIE_SPREAD) / F.greatest(F.col(value), F.lit(1)))


def with_daily_rank(rows: DataFrame, value: str, entity: str, day: str = "date_key") -> DataFrame:
    """Add ``daily_rank``, which is ``rank() over (partition by day order by value desc)``.

    ``value`` counts events of ``entity`` on ``day``. A window over the rows would put every
    entity of a day in one task. The rank of a row depends only on how many rows of its day have
    a greater value, so the window runs over (day, value) totals. Distinct counts that add up
    to N events number at most sqrt(2N), which keeps that window small for any day.

    The totals are then joined back. At most N/v entities can have value v, so the keys that
    can be hot are the small values, and those alone are spread: v over TIE_SPREAD/v salts.
    """
    totals = rows.groupBy(day, value).agg(F.count("*").alias("tied"))
    ahead = Window.partitionBy(day).orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("tied").over(ahead), F.lit(0)) + 1
    ranks = totals.select(
        F.col(day).alias("rank_day"), F.col(value).alias("rank_value"), rank.alias("daily_rank")
    ).withColumn("rank_salt", F.explode(F.sequence(F.lit(0), _salts("rank_value") - 1)))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(entity), _salts(value)))
    same_rank = (
        F.col(day).eqNullSafe(F.col("rank_day"))
        & (F.col(value) == F.col("rank_value"))
        & (F.col("salt") == F.col("rank_salt"))
    )
    return salted.join(ranks, same_rank).select(*rows.columns, "daily_rank")
