"""Reference data kept as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import SEED


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Repository languages with pinned types; a bigint repo_id joins as it is."""
    return spark.read.schema(SEED).option("header", True).csv(path)
