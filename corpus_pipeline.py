"""A training corpus from ``documents``: rules, line dedup, near-dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each as Parquet and rereads it
as the next one's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_dedup, mixing, quality_rules, simhash
from tidemark.llm.common import documents, staged
from tidemark.llm.queries import MOST, MOST_DROPPED, SCALE, WEIGHTS, WORD_BPE, domain_labels


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and lines over the limit of their host."""
    return quality_rules.apply_rules(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first."""
    return line_dedup.apply(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one that names it, its smallest doc_id."""
    return simhash.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the domains' tokens match their targets."""
    model = mixing.fit(docs, domain_labels(spark, sf_dir), "domain", list(WEIGHTS))
    return mixing.mixed(docs, model, WEIGHTS, SCALE, keep="good", most=MOST, most_dropped=MOST_DROPPED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their number and the decoded text."""
    coded = bpe.encode_decode(docs, WORD_BPE)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("source_mixing", mixture),
    ("bpe", tokens),
]

# The fingerprints, the memberships and the merges are beyond SQL; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
