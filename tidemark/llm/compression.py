"""Quality by compression: how much better a dictionary of good text compresses a text than one of bad text.

Two zstandard dictionaries are built from labelled texts, one of each class. A text is cut into blocks of
``BLOCK`` bytes, as a dictionary only helps before a text can refer to itself, and every block of the
whole text is compressed with either. The difference of the two sums, divided by their mean, is the
normalised difference; a logistic curve fitted on other labelled texts turns it, with the text's own
compression ratio, into a score.

Fitting takes at most ``SAMPLE`` labelled texts of each class, those with the smallest hash of their
doc_id, each cut to pieces of ``BLOCK`` bytes of which ``PIECES`` evenly spaced ones are used; scoring
takes every byte of every text.

Defined results: a NULL or empty text has the difference 0 and gets the score of that. Labels that are
NULL, or whose doc_id is NULL or repeated with another label, are not learned from. With labels of one
class only, or none, every score is the smoothed share of label 1 (0.5 without labels). Repeated rows get a score
each. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, picked, staged
from tidemark.llm.learning import fit_logistic, sampled, sigmoid

SAMPLE = 2500
PIECES = 8
BLOCK = 512
DICTIONARY = 112 * 1024
LEVEL = 3


@dataclass
class Model:
    """Dictionaries (as bytes) and the weights of the curve, for the executors."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def scorer(self):
        if not self.good or not self.bad:
            return lambda text: sigmoid(self.weights[0])
        measure = Measure(self.good, self.bad)
        return lambda text: sigmoid(float(np.dot(self.weights, measure.features(text))))


class Measure:
    def __init__(self, good: bytes, bad: bytes):
        settings = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.good, self.bad = (
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), **settings
            ).compress
            for d in (good, bad)
        )

    def features(self, text: str | None) -> tuple[float, float, float]:
        """1, the normalised difference (positive: nearer to good), and the ratio with the better of the two."""
        data = (text or "").encode()
        if not data:
            return 1.0, 0.0, 0.0
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        good = sum(len(self.good(b)) for b in blocks)
        bad = sum(len(self.bad(b)) for b in blocks)
        return 1.0, 20 * (bad - good) / (bad + good), min(good, bad) / len(data)


def pieces(text: str) -> list[bytes]:
    data = text.encode()
    starts = range(0, len(data), BLOCK)
    chosen = np.unique(np.linspace(0, len(starts) - 1, min(PIECES, len(starts))).astype(int))
    return [data[starts[i] : starts[i] + BLOCK] for i in chosen]


def fit(
    df: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    learn: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
) -> Model:
    """Dictionaries from two of three sampled texts of each class, the curve from the third ones.

    Only pieces of the former and measures of the latter come to the driver, at most ``PIECES * BLOCK``
    bytes for a sampled text.
    """
    known = staged(sampled(df, labels, label, learn, sample, doc_id, text), "sample")
    third = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    cut = map_rows(
        known.where(~third), lambda: lambda text: (pieces(text),), "parts array<binary>", ("doc_id", "label")
    )
    parts: dict[int, list[bytes]] = {0: [], 1: []}
    for r in cut.orderBy("doc_id").collect():
        parts[r.label] += map(bytes, r.parts)
    counts = dict(known.groupBy("label").count().collect())
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    certain = (math.log(share / (1 - share)), 0.0, 0.0)
    if not parts[0] or not parts[1]:
        return Model(b"", b"", certain)
    good, bad = dictionary(parts[1]), dictionary(parts[0])

    def start():
        measure = Measure(good, bad)
        return lambda text: (list(measure.features(text)),)

    measured = map_rows(known.where(third), start, "x array<double>", ("doc_id", "label"))
    held = measured.orderBy("doc_id").collect()
    if len({r.label for r in held}) < 2:
        return Model(good, bad, (0.0, 1.0, 0.0))
    weights = fit_logistic(np.array([r.x for r in held]), np.array([r.label for r in held], float))
    return Model(good, bad, tuple(weights.tolist()))


def dictionary(parts: list[bytes]) -> bytes:
    """A trained dictionary, or the raw text where there is too little of it to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY:]


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""

    def start():
        of = model.scorer()
        return lambda value: (of(value),)

    return map_rows(picked(df, doc_id=doc_id, text=text), start, "score double")
