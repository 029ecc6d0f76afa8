"""Join of event-grain rows to a lookup table, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_SHARE of the rows, so at most HOT_SHARE keys are.
HOT_SHARE = 1000


def hot_keys(
    rows: DataFrame, key: str, share: int = HOT_SHARE, counts: DataFrame | None = None, n: str = "n"
) -> DataFrame:
    """Keys with more than 1/share of all rows; never more than ``share`` of them.

    ``counts``, with the number of rows in its column ``n``, saves counting ``rows``; it may have several rows of a key.
    """
    counted = rows.groupBy(key).agg(F.count("*").alias("n"))
    if counts is not None:
        counted = counts.groupBy(key).agg(F.sum(n).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.where(F.col("n") * share > total).select(key)


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    share: int = HOT_SHARE,
    counts: DataFrame | None = None,
    n: str = "n",
) -> DataFrame:
    """Inner join to a lookup that is unique on ``key``, with no shuffle of the hot keys' rows.

    Keys with more than 1/share of the rows are hot. They are few by definition, so their lookup rows are broadcast. All other rows take
    the ordinary join, where no key is large enough to hold up a task. Stored ``counts`` of the rows spare the pass
    that finds the hot keys.
    """
    hot = hot_keys(rows, key, share, counts, n)
    hot_lookup = lookup.join(F.broadcast(hot), key, "left_semi")
    hot_rows = rows.join(F.broadcast(hot_lookup), key)
    cold_rows = rows.join(F.broadcast(hot), key, "left_anti").join(lookup, key)
    return hot_rows.unionByName(cold_rows)
