"""Quality rules: counts over each text, and lines that too many documents of a host share.

A line is normalised (lower case, white space to single spaces), hashed, and counted by host over the
distinct documents that hold it; exact copies are documents of their own. A line is over the limit where it
stands in more than ``LEAST_LIMIT`` documents of a host, however many that host has. ``max_share``
can ask for a share of the host's documents besides; it is 0 unless given, as a share would let a line of
a large host stand in any number of documents. Such a line is taken out of
every document of the host but the first (smallest doc_id), so that one document keeps it. A document that
loses so much that fewer than ``LEAST_WORDS`` words, or less than ``LEAST_LEFT`` of its words, are left is
depleted and rejected.

Defined results: a NULL text has no words; texts without words fail the base rules. A NULL host is a host
of its own. Rows equal in doc_id and text are one document and get the same answer each; a NULL doc_id
comes after all others. Other columns are ignored by the verdict and kept by ``apply_rules``. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, picked, staged, text_key

WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LEAST_WORDS = 20
MAX_REPEAT_PERCENT = 30

LEAST_LIMIT = 20
MAX_SHARE = 0.0
LEAST_LEFT = 0.2

_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(1, WINDOW + 1)], np.uint64)

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<struct<line:long, words:int>>"
)


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of ``WINDOW`` words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolling = np.zeros(n, np.uint64)
    for i, factor in enumerate(_FACTORS):
        rolling += hashes[i : i + n] * factor
    ordered = np.sort(rolling)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    # equal windows have equal hashes; of those with equal hashes the words decide
    seen: dict[tuple[bytes, ...], int] = {}
    candidates = np.flatnonzero(np.isin(rolling, twice)).tolist()
    windows = [tuple(words[i : i + WINDOW]) for i in candidates]
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    edges = np.zeros(len(words) + 1, np.int64)
    for i, window in zip(candidates, windows):
        if seen[window] > 1:
            edges[i] += 1
            edges[i + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def line_hash(line: str) -> int:
    digest = xxhash.xxh64_intdigest(b" ".join(line.lower().encode().split()))
    return digest - (1 << 64) if digest >> 63 else digest


def text_stats(text: str | None) -> tuple:
    text = text or ""
    words = text.encode().split()
    seen: set[str] = set()
    repeated = 0
    lines = []
    for line in text.split("\n"):
        count = len(line.encode().split())
        if count:
            repeated += line in seen
            seen.add(line)
            lines.append((line_hash(line), count))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeated,
        repeat_words(words),
        lines,
    )


def base_failed() -> Column:
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    return (F.col("n_words") < LEAST_WORDS) | repeats


def _stats(df: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    rows = picked(df, doc_id=doc_id, text=text, host=host).withColumn("key", text_key())
    marked = map_rows(rows, lambda: text_stats, STATS, keep=("doc_id", "host", "key"))
    return staged(marked, "line-stats")


def frequent_lines(
    stats: DataFrame, least_limit: int = LEAST_LIMIT, max_share: float = MAX_SHARE
) -> DataFrame:
    """(host, line, first): lines over the limit, with the document that keeps each."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    document = F.xxhash64("doc_id", "key")
    lines = stats.select("host", "key", "doc_id", F.explode("lines.line").alias("line"))
    counts = lines.groupBy("host", "line").agg(
        F.countDistinct(document).alias("documents"), F.min(rank).alias("first")
    )
    over = counts.where(F.col("documents") > least_limit)
    if max_share > 0:
        hosts = stats.groupBy("host").agg(F.countDistinct(document).alias("host_documents"))
        hosts = hosts.withColumnRenamed("host", "of")
        over = over.join(hosts, F.col("host").eqNullSafe(F.col("of")))
        over = over.where(F.col("documents") > F.col("host_documents") * max_share)
    return over.select("host", "line", "first")


def _removed(stats: DataFrame, frequent: DataFrame) -> DataFrame:
    """(doc_id, key, removed_words, removed_lines) of each document that loses lines."""
    once = stats.dropDuplicates(["doc_id", "key", "host"])
    lines = once.select("doc_id", "key", "host", F.posexplode("lines").alias("at", "found"))
    lines = lines.select("doc_id", "key", "host", "at", "found.*")
    over = frequent.select(
        F.col("host").alias("over_host"), F.col("line").alias("over_line"), "first"
    )
    hit = lines.join(
        over,
        F.col("host").eqNullSafe(F.col("over_host")) & (F.col("line") == F.col("over_line")),
    )
    keeps = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    return hit.where(~keeps).groupBy("doc_id", "key", "host").agg(
        F.sum("words").alias("removed_words"), F.collect_set("line").alias("removed_lines")
    )


def _with_verdict(stats: DataFrame, removed: DataFrame, least_left: float) -> DataFrame:
    gone = removed.select(
        F.col("doc_id").alias("of_id"),
        F.col("key").alias("of_key"),
        F.col("host").alias("of_host"),
        "removed_words",
        "removed_lines",
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("of_id"))
        & (F.col("key") == F.col("of_key"))
        & F.col("host").eqNullSafe(F.col("of_host"))
    )
    lost = F.coalesce("removed_words", F.lit(0))
    left = F.col("n_words") - lost
    depleted = (lost > 0) & ((left < LEAST_WORDS) | (left < F.col("n_words") * least_left))
    return (
        stats.join(gone, same, "left")
        .withColumn("base_failed", base_failed())
        .withColumn("removed_words", lost.cast("long"))
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .drop("of_id", "of_key", "of_host")
    )


def verdicts(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    least_limit: int = LEAST_LIMIT,
    max_share: float = MAX_SHARE,
    least_left: float = LEAST_LEFT,
) -> DataFrame:
    """One row for each row of ``df``: the counts, base_failed, removed_words and kept."""
    stats = _stats(df, doc_id, text, host)
    removed = _removed(stats, frequent_lines(stats, least_limit, max_share))
    return _with_verdict(stats, removed, least_left).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "removed_words",
    )


def apply_rules(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    least_limit: int = LEAST_LIMIT,
    max_share: float = MAX_SHARE,
    least_left: float = LEAST_LEFT,
) -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns, and without the lines over the limit."""
    stats = _stats(df, doc_id, text, host)
    removed = _removed(stats, frequent_lines(stats, least_limit, max_share))
    judged = _with_verdict(stats, removed, least_left)
    # only documents that change need to be told
    told = judged.where(~F.col("kept") | F.col("removed_lines").isNotNull())
    told = told.groupBy(
        F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), F.col("host").alias("of_host")
    ).agg(F.first("kept").alias("kept"), F.first("removed_lines").alias("removed"))
    # numbered names inside: a caller's may be equal to new ones
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = {c: f"c{i}" for i, c in enumerate(df.columns)}
    same = (
        F.col(at[doc_id]).eqNullSafe(F.col("of_id"))
        & (F.xxhash64(at[text]) == F.col("of_key"))
        & F.col(at[host]).eqNullSafe(F.col("of_host"))
    )
    joined = numbered.join(told, same, "left").where(F.coalesce("kept", F.lit(True)))

    def start():
        def of_row(value, lines):
            if not lines:
                return (value,)
            gone = set(lines)
            return ("\n".join(x for x in value.split("\n") if not x.encode().split() or line_hash(x) not in gone),)

        return of_row

    others = [c for c in at.values() if c != at[text]]
    asked = joined.select(*others, at[text], "removed")
    left = map_rows(asked, start, "left string", keep=others)
    return left.select(*["left" if c == at[text] else c for c in at.values()]).toDF(*df.columns)
