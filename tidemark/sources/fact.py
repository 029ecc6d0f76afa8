"""The fact table on disk: partitioned by event_date, sorted by event_type inside."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from tidemark.operators.quality import unique
from tidemark.schemas import FACT_COLUMNS
from tidemark.sources import fact_ids
from tidemark.sources.swaps import finish_swaps
from tidemark.sources.tables import (
    read_table,
    replace_partitions,
    replace_table,
    stage,
)

_KINDS = {"date_key": LongType(), "event_date": DateType(), "created_at": TimestampType()}
_LAST = ["event_date"]
FACT = StructType(
    [
        StructField(c, _KINDS.get(c, StringType()))
        for c in [*[c for c in FACT_COLUMNS if c not in _LAST], *_LAST]
    ]
)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, FACT).select(*FACT_COLUMNS)


def read_fact_days(spark: SparkSession, path: str, days: Iterable[date]) -> DataFrame:
    return read_table(spark, path, FACT, "event_date", days).select(*FACT_COLUMNS)


def latest(rows: DataFrame) -> DataFrame:
    """One row per event_id: the one created last, other columns breaking ties; NULL ids all stay."""
    rest = ["created_at", *[c for c in FACT_COLUMNS if c not in ("event_id", "created_at")]]
    alone = F.when(F.col("event_id").isNull(), F.monotonically_increasing_id())
    kept = rows.withColumn("alone", alone).groupBy("event_id", "alone").agg(
        F.max(F.struct(*rest)).alias("kept")
    )
    return kept.select("event_id", "kept.*").select(*FACT_COLUMNS)


def write_fact(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    full_refresh: bool = False,
    events_may_move: bool = True,
) -> list[date]:
    """Upsert ``incoming`` on event_id, rewriting only the days it touches; returns those days.

    The fact has one row per event_id over all days. Incoming rows that repeat an id are refused (see
    ``latest``). Where an id comes again in another call, the later row stays, so calls in any order end in
    the same table. ``events_may_move`` looks for incoming ids on other days, in the blocks of the id index
    that they fall in (``fact_ids``); a fact without an index, as an earlier version left it, gets one first.
    Turn that off where an id is known never to come on two days. New days are written whole before any
    target file goes, and a swap that was cut short is finished by the next call.
    """
    if set(incoming.columns) != set(FACT_COLUMNS):
        raise ValueError(f"fact columns changed: {sorted(set(incoming.columns) ^ set(FACT_COLUMNS))}")
    finish_swaps(spark, path, 1)
    incoming = stage(incoming.select(*FACT_COLUMNS), "fact-incoming")
    repeated = unique(incoming, "event_id").take(1)
    if repeated:
        raise ValueError(f"incoming rows repeat event_id {repeated[0]['event_id']}")
    index = fact_ids.ids_path(path)
    if full_refresh:
        # an index that does not cover the fact must not be there at any time
        fact_ids.drop_index(spark, index)
        replace_table(incoming, path, ["event_date"], ["event_type"])
        fact_ids.build_index(incoming, index)
        return [r.event_date for r in incoming.select("event_date").distinct().collect()]

    days = incoming.select("event_date").distinct()
    if not fact_ids.has_index(spark, index):
        fact_ids.build_index(read_fact(spark, path), index)
    pairs = fact_ids.pairs_of(incoming)
    blocks = fact_ids.blocks_of(pairs)
    if events_may_move:
        moved = fact_ids.known_days(spark, index, pairs, blocks).select("event_date")
        days = days.unionByName(moved).distinct()
    # calendar days, bounded by the calendar
    touched = [r.event_date for r in days.collect()]
    fact_ids.add_pairs(spark, index, pairs, blocks)
    merged = latest(read_fact_days(spark, path, touched).unionByName(incoming))
    owned = [Row(event_date=d.isoformat()) for d in touched]
    replace_partitions(merged, path, ["event_date"], ["event_type"], owned)
    return touched
