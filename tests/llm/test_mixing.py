"""Rates against the same least squares solved in one place, and held-out memberships."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.cases import DOCUMENTS, row
from tidemark.llm import mixing

NAMES = ["red", "blue", "grey"]
WORDS = {"red": "rose blood ruby fire brick", "blue": "sea sky ink ice lake", "grey": "ash stone fog lead dust"}


def sentence(i):
    """Document i: mostly of one domain, with some words of the next."""
    own, other = NAMES[i % 3], NAMES[(i + 1) % 3]
    rng = np.random.default_rng(i)
    words = list(rng.choice(WORDS[own].split(), 12)) + list(rng.choice(WORDS[other].split(), i % 5))
    return " ".join(words * (1 + i % 4))


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([row(i, sentence(i)) for i in range(240)], DOCUMENTS)


@pytest.fixture(scope="module")
def model(spark, corpus):
    labels = spark.createDataFrame([(i, NAMES[i % 3]) for i in range(0, 240, 2)], "doc_id long, domain string")
    return mixing.fit(corpus, labels, "domain", NAMES)


def test_unlabelled_documents_are_placed(corpus, model):
    placed = mixing.memberships(corpus, model).where("doc_id % 2 = 1").collect()
    hits = [NAMES[int(np.argmax(r.posterior))] == NAMES[r.doc_id % 3] for r in placed]
    assert np.mean(hits) > 0.95
    assert all(abs(sum(r.posterior) - 1) < 1e-9 for r in placed)


def solve(tokens, posterior, targets):
    """Projected gradient over all documents, plainly and for long."""
    rates = np.ones(len(tokens))
    weighted = posterior * tokens[:, None]
    step = 1 / np.linalg.eigvalsh((posterior.T @ weighted) / np.sqrt(np.outer(targets, targets)))[-1]
    for _ in range(20_000):
        miss = (rates @ weighted - targets) / targets
        rates = np.maximum(0, rates - step * (posterior @ miss))
    return rates


@pytest.mark.parametrize("weights", [(0.6, 0.3, 0.1), (0.2, 0.2, 0.6)])
def test_expected_totals_match(corpus, model, weights):
    got = mixing.rates(corpus, model, dict(zip(NAMES, weights)), 0.8).collect()
    tokens = np.array([r.n_tokens for r in got], float)
    posterior = np.array([r.posterior for r in got])
    rates = np.array([r.rate for r in got])
    targets = np.array(weights) * tokens.sum() * 0.8
    assert (rates >= 0).all()
    np.testing.assert_allclose(rates @ (posterior * tokens[:, None]), targets, rtol=1e-4)
    np.testing.assert_allclose(rates, solve(tokens, posterior, targets), atol=0.02)
    assert [r.n_tokens for r in sorted(got)] == [len(sentence(r.doc_id).split()) for r in sorted(got)]


def test_mixed_repeats_and_drops(corpus, model):
    weights = {"red": 0.8, "blue": 0.15, "grey": 0.05}
    out = mixing.mixed(corpus, model, weights, 1.0)
    assert out.columns == corpus.columns
    counts = dict(out.groupBy("doc_id").count().collect())
    wanted = {r.doc_id: r.rate for r in mixing.rates(corpus, model, weights, 1.0).collect()}
    assert all(abs(counts.get(i, 0) - r) < 1 for i, r in wanted.items())


def test_edge_rows(spark, edge, nothing, model):
    got = mixing.rates(edge, model, {"red": 1.0, "blue": 1.0, "grey": 1.0}).collect()
    assert len(got) == edge.count() and all(r.rate >= 0 for r in got)
    assert mixing.rates(nothing, model, {"red": 1.0}).count() == 0
    assert mixing.mixed(nothing, model, {"red": 1.0}).count() == 0
    mixing.mixed(edge, model, {"red": 1.0, "blue": 1.0, "grey": 1.0}).count()


def test_no_labels_or_strange_ones(spark, corpus):
    labels = spark.createDataFrame(
        [(None, "red"), (1, None), (2, "green"), (3, "red"), (3, "blue")], "doc_id long, domain string"
    )
    model = mixing.fit(corpus, labels, "domain", NAMES)
    placed = mixing.memberships(corpus, model).agg(F.max(F.array_max("posterior"))).first()
    assert placed[0] <= 0.34


def test_query_meets_fixed_targets_on_skewed_shares(spark, corpus, tmp_path):
    """A third of the documents each are good, poor and toxic."""
    from tidemark.llm.queries import QUERIES

    corpus.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 3 != 1), int(i % 3 == 2)) for i in range(0, 240, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op2_source_mixing"](spark, str(tmp_path)).collect()
    expected = np.array([r.n_tokens * r.rate for r in got]) @ np.array([r.posterior for r in got])
    targets = np.array([0.85, 0.07, 0.08]) * 1.25 * sum(r.n_tokens for r in got)
    np.testing.assert_allclose(expected, targets, rtol=1e-3)
    assert all(r.rate >= 1 for r in got if r.posterior[0] >= mixing.SURE)


def test_rounds_go_on_to_the_target_and_misses_are_told(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROUNDS", 1)
    posterior = [[0.90, 0.06, 0.04], [0.84, 0.10, 0.06], [0.80, 0.10, 0.10], [0.1, 0.5, 0.4]]
    totals = spark.createDataFrame([(p, 1000) for p in posterior], "posterior array<double>, tokens long")
    met = mixing.descend(totals, np.array([2600.0, 700.0, 600.0]))
    assert max(map(abs, met.misses)) < 0.01
    monkeypatch.setattr(mixing, "HERE_ROWS", 0)
    spread = mixing.descend(totals.coalesce(1), np.array([2600.0, 700.0, 600.0]))
    np.testing.assert_allclose(spread.misses, met.misses, atol=1e-6)
    sure = np.array(posterior)[:3]
    bound = mixing.descend(totals, np.array([2600.0, 0.1, 0.1]), kept=0)
    assert (bound.rates(sure) >= 1).all() and max(map(abs, bound.misses)) > 0.5


def unsure(certainty, size=20_000):
    """Token totals of documents whose posteriors have so much of the truth, the rest being noise."""
    rng = np.random.default_rng(3)
    truth = np.eye(3)[rng.choice(3, size, p=[0.56, 0.2, 0.24])]
    posterior = np.round(certainty * truth + (1 - certainty) * rng.dirichlet([1, 1, 1], size), 3)
    return posterior / posterior.sum(axis=1, keepdims=True), rng.lognormal(5, 1, size).astype(int) + 1


@pytest.fixture(scope="module")
def names():
    return mixing.Domains(NAMES, np.zeros((mixing.BUCKETS, 3), np.float32), np.zeros((7, 3)))


@pytest.mark.parametrize("certainty", [1.0, 0.9, 0.5, 0.3, 0.1])
def test_unsure_posteriors_do_not_drop_the_documents(spark, names, certainty):
    posterior, tokens = unsure(certainty)
    rows = [(p, int(n)) for p, n in zip(posterior.tolist(), tokens.tolist())]
    placed = spark.createDataFrame(rows, "posterior array<double>, n_tokens long")
    weights = dict(zip(NAMES, (0.85, 0.07, 0.08)))
    descent = mixing.solved(placed, names, weights, 1.25, False, "red", 8.0, 0.05)
    rates = descent.rates(posterior)
    assert np.mean(rates <= mixing.DROPPED) <= 0.05 and rates.max() <= 8
    targets = np.array([0.85, 0.07, 0.08]) * 1.25 * tokens.sum()
    np.testing.assert_allclose((tokens * rates) @ posterior / targets - 1, descent.misses, atol=1e-6)
    if certainty >= 0.9:
        assert descent.ridge == 0 and max(map(abs, descent.misses)) < 1e-4
    else:
        assert descent.ridge > 0 and max(map(abs, descent.misses)) > 0.1
    # the same documents five times over have the same rates
    if certainty == 0.3:
        more = placed.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("again")
        again = mixing.solved(more, names, weights, 1.25, False, "red", 8.0, 0.05)
        np.testing.assert_allclose(again.rates(posterior), rates, atol=1e-6)


def test_the_ridge_finds_the_least_sum(spark, names):
    posterior, tokens = unsure(0.5, 300)
    totals = spark.createDataFrame(
        [(p, int(n)) for p, n in zip(posterior.tolist(), tokens.tolist())], "posterior array<double>, tokens long"
    )
    targets = np.array([0.85, 0.07, 0.08]) * 1.25 * tokens.sum()
    descent = mixing.descend(totals, targets, ridge=0.3, most=2.0)
    rates = descent.rates(posterior)
    slow = np.ones(len(tokens))
    for _ in range(30_000):
        miss = (tokens * slow) @ posterior / targets - 1
        slow = np.clip(slow - 0.02 * (posterior @ miss + 0.3 * (slow - 1)), 0, 2)
    np.testing.assert_allclose(rates, slow, atol=0.01)


def test_a_batch_works_out_each_posterior_once(monkeypatch):
    descent = mixing.Descent(0.1, 0)
    descent.gradients, descent.momenta = [np.array([-1.0, 2.0, 0.5])] * 4, [0.0, 0.1, 0.2, 0.3]
    some = np.array([[0.5, 0.25, 0.25], [1.0, 0.0, 0.0], [0.2, 0.3, 0.5]])
    rows = some[[0, 1, 0, 2, 2, 1, 0]]
    asked = []
    rates = mixing.Descent.rates
    monkeypatch.setattr(mixing.Descent, "rates", lambda self, p, *a: asked.append(len(p)) or rates(self, p, *a))
    made = descent.rates_of_rows(pa.array(rows.tolist()))
    np.testing.assert_allclose(made, [rates(descent, row[None])[0] for row in rows])
    assert asked == [3] and len(descent.rates_of_rows(pa.array([], pa.list_(pa.float64())))) == 0


def test_report_tells_targets_and_misses(corpus, model):
    weights = {"red": 0.8, "blue": 0.15, "grey": 0.05}
    rated = mixing.rates(corpus, model, weights, 1.0)
    rows = rated.collect()
    everything = sum(r.n_tokens for r in rows)
    for at, r in enumerate(mixing.report(rated, model, weights, 1.0).collect()):
        assert r.domain == NAMES[at] and abs(r.target - weights[r.domain] * everything) < 1e-6
        assert abs(r.reached - sum(x.n_tokens * x.rate * x.posterior[at] for x in rows)) < 1e-6
        assert abs(r.miss - (r.reached - r.target) / r.target) < 1e-9
        assert (r.documents, r.largest_rate) == (240, max(x.rate for x in rows))
        assert r.dropped == sum(x.rate <= mixing.DROPPED for x in rows)


def test_chances_follow_the_labelled_shares(spark, corpus):
    """The words tell nothing, so what is left are the shares among the labels: 1 of 4, 3 of 4, none."""
    same = corpus.withColumn("text", F.lit("one text for all"))
    labels = spark.createDataFrame([(i, NAMES[i % 4 > 0]) for i in range(200)], "doc_id long, domain string")
    model = mixing.fit(same, labels, "domain", NAMES, sample=60)
    (got,) = mixing.memberships(same, model).select("posterior").distinct().collect()
    np.testing.assert_allclose(got.posterior, [0.25, 0.75, 0], atol=0.06)
