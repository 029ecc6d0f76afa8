"""The registered query of each operator: (spark, sf_dir) -> DataFrame over the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    compression,
    filter_audit,
    fingerprint,
    html_text,
    line_dedup,
    mixing,
    quality_rules,
    secret_scan,
    simhash,
    source_divergence,
    token_counts,
    toxicity,
)
from tidemark.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

# Domains of the label table, and the share of all tokens each is to have. All tokens together are to be a
# quarter more than there are, so that good text is rather repeated than lost.
WEIGHTS = {"good": 0.85, "poor": 0.07, "toxic": 0.08}
SCALE = 1.25
# No document is repeated more often than this, and at most this share of them is dropped.
MOST = 8.0
MOST_DROPPED = 0.05


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def labels(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _remainder(by: int):
    return F.crc32(F.col("doc_id").cast("string")) % by


def _judged(scored: DataFrame, held_out, least: float) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"),
    )


@query
def op1_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    grammar = toxicity.fit(docs, labels(spark, sf_dir), learn=_remainder(3) != 1)
    return _judged(toxicity.score(docs, grammar), _remainder(3) == 1, 0.7)


def domain_labels(spark, sf_dir) -> DataFrame:
    toxic, quality = F.col("toxic"), F.col("quality")
    domain = F.when(toxic == 1, "toxic").when(quality == 0, "poor").when(quality == 1, "good")
    return labels(spark, sf_dir).select("doc_id", domain.alias("domain"))


@query
def op2_source_mixing(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = mixing.fit(docs, domain_labels(spark, sf_dir), "domain", list(WEIGHTS))
    return mixing.rates(docs, model, WEIGHTS, SCALE, keep="good", most=MOST, most_dropped=MOST_DROPPED)


@query
def op3_line_dedup(spark, sf_dir):
    return line_dedup.deduplicated(documents(spark, sf_dir))


@query
def op4_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = compression.fit(docs, labels(spark, sf_dir), learn=_remainder(5) != 0)
    return _judged(compression.score(docs, model), _remainder(5) == 0, 0.3)


@query
def op5_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), PIECES)


@query
def op6_html_extraction(spark, sf_dir):
    return html_text.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op7_quality_rules(spark, sf_dir):
    return quality_rules.verdicts(documents(spark, sf_dir))


@query
def op8_bpe(spark, sf_dir):
    coded = bpe.encode_decode(documents(spark, sf_dir), WORD_BPE)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.listed("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op10_fingerprints(spark, sf_dir):
    return fingerprint.with_next(documents(spark, sf_dir))


@query
def op11_secret_scan(spark, sf_dir):
    base = [rule.kind for rule in secret_scan.BASE]
    found = secret_scan.find_secrets(documents(spark, sf_dir))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[F.size(secret_scan.of_kinds(spans, [k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(secret_scan.listed(secret_scan.of_kinds(spans, base)), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


@query
def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(documents(spark, sf_dir), labels(spark, sf_dir))


@query
def op13_source_divergence(spark, sf_dir):
    return source_divergence.divergence(documents(spark, sf_dir))
