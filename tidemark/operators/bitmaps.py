"""Exact distinct counts that can be merged: bitmaps of numeric ids, kept by hour.

An id is a bit of the bitmap of its bucket; bitmaps of several hours are united, and the bits counted. A day's or a
table's number of distinct ids comes from the stored bitmaps, without reading an event. An hour's ids lie close
together, so an hour has few buckets. Ids that are no numbers cannot be bits; they are kept as they are, by hour.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import HOUR_COLUMNS

BITMAP_COLUMNS = [*HOUR_COLUMNS, "total_rows", "bucket", "bits", "other_ids"]


def _number(event_id: str) -> Column:
    """The id as a number, if its text is that number's own; the others would meet another id's bit."""
    number = F.col(event_id).try_cast("bigint")
    return F.when(number.cast("string") == F.col(event_id), number)


def id_bitmaps(silver: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Rows (hour, bucket, bits) of numeric ids, and for each hour one without a bucket, which has its number of rows
    and its other ids."""
    number = _number(event_id)
    tagged = silver.select(*HOUR_COLUMNS, F.col(event_id).alias("id"), number.alias("number"))
    numeric = tagged.where("number IS NOT NULL")
    bits = numeric.groupBy(*HOUR_COLUMNS, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )
    others = tagged.groupBy(*HOUR_COLUMNS).agg(
        F.count("*").alias("total_rows"), F.collect_set(F.when(F.col("number").isNull(), F.col("id"))).alias("other_ids")
    )
    return bits.withColumns(
        {"total_rows": F.lit(None).cast("bigint"), "other_ids": F.lit(None).cast("array<string>")}
    ).select(*BITMAP_COLUMNS).unionByName(
        others.withColumns({"bucket": F.lit(None).cast("bigint"), "bits": F.lit(None).cast("binary")}).select(*BITMAP_COLUMNS)
    )


def distinct_ids(bitmaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, total_rows, distinct_event_ids) over the hours of ``bitmaps``, grouped by any of their columns."""
    united = bitmaps.where("bucket IS NOT NULL").groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    numeric = united.select(*by, F.bitmap_count("bits").alias("n"), F.lit(0).cast("bigint").alias("total_rows"))
    whole = bitmaps.where("bucket IS NULL")
    others = whole.select(*by, F.explode("other_ids").alias("id")).distinct()
    others = others.select(*by, F.lit(1).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("total_rows"))
    rows = whole.select(*by, F.lit(0).cast("bigint").alias("n"), "total_rows")
    every = numeric.unionByName(others).unionByName(rows)
    return every.groupBy(*by).agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("distinct_event_ids"),
    )


def repeated(totals: DataFrame) -> DataFrame:
    """What of ``distinct_ids`` holds an id more than once, and how many rows that are too many; ids that are NULL
    are among them."""
    return totals.where("total_rows > distinct_event_ids").withColumn(
        "surplus", F.col("total_rows") - F.col("distinct_event_ids")
    )
