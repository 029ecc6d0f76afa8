"""Accuracy on texts kept apart, blocks of whole texts, and odd labels."""

import math
import random

from pyspark.sql import functions as F

from llm.cases import DOCUMENTS, EDGE_ROWS, row
from tidemark.llm import compression
from tidemark.llm.learning import fit_logistic
from tidemark.llm.queries import op4_quality_classifier


def _text(i):
    rng = random.Random(i)
    words = [rng.choice("river stone cloud maple window garden silver winter".split()) for _ in range(150)]
    if i % 3:
        return " ".join(words).capitalize() + "."
    return " ".join(w.upper() + "!! $$$" for w in words)


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_judges_unseen_texts(spark):
    docs = spark.createDataFrame([row(i, _text(i)) for i in range(120)], DOCUMENTS)
    model = compression.fit(docs, _labels(spark, [(i, int(i % 3 > 0)) for i in range(0, 120, 2)]))
    scored = compression.score(docs, model).where("doc_id % 2 = 1").collect()
    assert all((r.score > 0.5) == (r.doc_id % 3 > 0) for r in scored)


def test_every_block_counts():
    good, bad = _text(1).encode() * 20, _text(3).encode() * 20
    measure = compression.Measure(compression.dictionary([good]), compression.dictionary([bad]))
    head = measure.features(_text(2) * 3)[1]
    tail = measure.features(_text(2) * 3 + _text(6) * 60)[1]
    assert head > 0 > tail
    assert measure.features(None) == measure.features("") == (1.0, 0.0, 0.0)


def test_edge_rows_and_labels(spark, edge, nothing):
    odd = _labels(spark, [(None, 1), (1, None), (2, 0), (2, 1), (9, 7)])
    got = compression.score(edge, compression.fit(edge, odd)).collect()
    assert len(got) == len(EDGE_ROWS) and {r.score for r in got} == {0.5}
    assert compression.score(nothing, compression.fit(nothing, odd)).count() == 0
    both = _labels(spark, [(1, 1), (6, 0), (7, 0), (8, 1), (10, 1)])
    got = compression.score(edge, compression.fit(edge, both)).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r.score <= 1 for r in got)


def test_logistic_curve_is_the_known_solution():
    import numpy as np

    x = np.array([[1.0, v] for v in (-2, -1, 0, 1, 2)] * 20)
    y = np.array(([0, 0, 1, 1, 1] * 10) + ([0, 1, 0, 1, 1] * 10), float)
    w = fit_logistic(x, y, ridge=0.0)
    p = 1 / (1 + np.exp(-x @ w))
    np.testing.assert_allclose(x.T @ (y - p), 0, atol=1e-6)


def test_query(spark, small):
    df = op4_quality_classifier(spark, small)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    ranks = df.agg(F.min("score"), F.max("score"), F.count("*")).first()
    assert 0 <= ranks[0] <= ranks[1] <= 1 and ranks[2] == 200


def test_held_out_accuracy(spark):
    """Area under the curve over documents whose labels were not learned."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    scored = op4_quality_classifier(spark, sf).where("held_out").join(labels, "doc_id").where("quality IS NOT NULL")
    got = [(r.score, r.quality) for r in scored.collect()]
    assert len({q for _, q in got}) == 2
    assert area(got) > 0.95


def area(scored):
    """Chance that a document of label 1 scores above one of label 0."""
    good, bad = ([s for s, label in scored if label == wanted] for wanted in (1, 0))
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


def plain_score(model, text):
    """The whole text in blocks, compressed with either dictionary by zstandard itself."""
    import zstandard

    data = (text or "").encode()
    sums = []
    for dictionary in (model.good, model.bad):
        total = 0
        for at in range(0, len(data), 512):
            made = zstandard.ZstdCompressor(
                level=3, dict_data=zstandard.ZstdCompressionDict(dictionary),
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            total += len(made.compress(data[at : at + 512]))
        sums.append(total)
    good, bad = sums
    difference = 20 * (bad - good) / (bad + good) if data else 0.0
    ratio = min(good, bad) / len(data) if data else 0.0
    a, b, c = model.weights
    return 1 / (1 + math.exp(-(a + b * difference + c * ratio)))


def test_scores_as_written_out(spark):
    docs = spark.createDataFrame([row(i, _text(i)) for i in range(120)] + [row(500, ""), row(501, "é" * 700)], DOCUMENTS)
    model = compression.fit(docs, _labels(spark, [(i, int(i % 3 > 0)) for i in range(0, 120, 2)]))
    texts = dict(docs.select("doc_id", "text").collect())
    for r in compression.score(docs.where("doc_id % 5 = 0 OR doc_id >= 500"), model).collect():
        assert abs(r.score - plain_score(model, texts[r.doc_id])) < 1e-9
