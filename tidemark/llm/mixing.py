"""Mixing to target weights with soft membership.

A classifier learned from a labelled table gives every document a posterior over the domains: hashed words
weighed by how much more often a domain has them than all domains together, and a softmax curve fitted on
labelled texts kept apart. The sample has as many texts of each domain; the curve's chances are then brought to
the shares that the domains have among all labelled rows. Posteriors are rounded to ``STEPS`` parts.

Document rates r >= 0 are then fitted so that the expected tokens of each domain, sum of r * tokens *
posterior, match the targets: accelerated projected-gradient least squares on the relative misses, from
r = 1, whose momentum starts anew where the misses grow. With ``keep``, a domain's name, documents whose
posterior of it is ``SURE`` or more have a rate of 1 at least, so that none is lost for a trace of another
domain; no rate is above ``most``. The rounds end when every target is met to ``CLOSE``, or when 25 of them
bring no progress; what is missed then is kept with the steps and warned of.

Where posteriors are unsure, targets can only be met by repeating a few documents very often and dropping nearly
all others. ``most_dropped``, a share of the documents, adds a ridge toward rate 1 for that case: none as long
as no larger share gets a rate of 0 (up to ``DROPPED``), else the first of ``RIDGES`` that keeps to it. So
targets are met exactly where that is possible with rates that keep the documents, and where it is not, rates
stay near 1 and the targets' misses, which ``report`` returns, are what is left. Being a share, the bound means the
same for a table of any size.

A gradient step moves a document by its posterior alone (gradients are taken per token), so
documents of one posterior have one rate, and the iterations run over token totals by posterior. Three
domains have at most 501,501 rounded posteriors however many documents there are; a table of up to
``HERE_ROWS`` of them, counted first, is iterated over on the driver. A larger one stays distributed; a pass
sends one number for each domain to the driver and none of the rates. The memberships are stored once, and a
task works out the rates of a batch's different posteriors together, from the steps.

Defined results: a NULL or empty text has no tokens, the posterior that no evidence gives, and a rate like
any other. A domain without labelled texts has posterior 0 everywhere; with no labelled text at all
every domain has the same. A target that cannot be met (an empty domain, rates that would be negative)
leaves the least-squares miss. Labels that are NULL, unknown, or whose doc_id is NULL or repeated with
another label, are not learned from. Repeated rows get the same answer each. Other columns are ignored by
``rates`` and kept by ``mixed``; an empty table gives an empty result.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tidemark.llm.common import map_batches, map_rows, picked, staged
from tidemark.llm.learning import sampled

# Sampled texts of each domain, word buckets, bytes of a word's beginning, and how weights are shrunk.
SAMPLE = 1500
BUCKETS = 1 << 17
BEGINNING = 5
SHRINK = 2.0
LEAST_DEVIATION = 3.5
STEPS = 1000
# The iterations end at this relative miss, or when so many bring less than a thousandth.
CLOSE = 1e-5
ROUNDS = 25
# Documents of the kept domain with at least this posterior are never dropped.
SURE = 0.8
# A rate up to this counts as 0.
DROPPED = 0.01
# Weights of the ridge that are tried, up to one that leaves every rate near 1.
RIDGES = [0.01 * 2**i for i in range(14)]
# Posteriors the driver iterates over itself: 20 MB with three domains.
HERE_ROWS = 600_000


@dataclass
class Domains:
    """Word weights (bucket, domain) and the curve over the features."""

    names: list[str]
    words: np.ndarray
    curve: np.ndarray

    def features(self, text: str | None) -> tuple[int, np.ndarray]:
        """(number of words, features)."""
        found = (text or "").lower().encode().split()
        buckets = word_buckets(found)
        evidence = self.words[buckets].sum(axis=0, dtype=np.float64)
        spread = evidence / np.sqrt(1 + len(buckets))
        return len(found), np.concatenate(([1.0], evidence / 10, spread))

    def posterior(self, features: np.ndarray) -> list[float]:
        """Rounded, and of sum 1: what rounding leaves goes to the likeliest domain."""
        share = softmax(features @ self.curve)
        parts = np.rint(share * STEPS).astype(int)
        parts[int(np.argmax(share))] += STEPS - parts.sum()
        return (parts / STEPS).tolist()


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, classes: int, ridge: float = 1e-3) -> np.ndarray:
    """Accelerated gradient descent on the mean log loss; only classes present in ``y`` can be predicted."""
    scale = np.abs(x).max(axis=0) + 1e-9
    z, target = x / scale, np.eye(classes)[y]
    weights = ahead = np.zeros((x.shape[1], classes))
    step = 2.0 / (np.linalg.norm(z, 2) ** 2 / len(z) + 2 * ridge)
    for t in range(600):
        gradient = z.T @ (softmax(z @ ahead) - target) / len(z) + ridge * ahead
        new = ahead - step * gradient
        weights, ahead = new, new + t / (t + 3) * (new - weights)
    weights = weights / scale[:, None]
    weights[0, np.bincount(y, minlength=classes) == 0] -= 1e3
    return weights


def word_buckets(words: list[bytes]) -> np.ndarray:
    """Buckets of the different words and of their beginnings."""
    different = set(words)
    different |= {b"*" + w[:BEGINNING] for w in different}
    return np.unique(np.fromiter(map(zlib.crc32, different), np.int64, len(different)) % BUCKETS)


def word_weights(seen: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Logarithm of how much more often a domain's texts have a bucket than all texts do.

    Shrunk towards 0, and 0 where the difference is within ``LEAST_DEVIATION`` deviations of chance.
    """
    expected = seen.sum(axis=1, keepdims=True) / max(1.0, texts.sum()) * texts
    weights = np.log((seen + SHRINK) / (expected + SHRINK))
    weights[np.abs(seen - expected) < LEAST_DEVIATION * np.sqrt(expected + 1)] = 0.0
    return weights.astype(np.float32)


def fit(
    df: DataFrame,
    labels: DataFrame,
    domain: str,
    names: list[str],
    learn: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
) -> Domains:
    """Word weights from two of three sampled texts of each domain, the curve from the third ones.

    The driver gets at most ``BUCKETS`` counts for each domain and a few numbers for each sampled text.
    """
    count = len(names)
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(f"`{domain}`")) - 1
    labelled = picked(labels, doc_id=doc_id, **{domain: domain}).select("doc_id", number.alias("label"))
    labelled = labelled if learn is None else labelled.where(learn)
    known = sampled(df, labelled, "label", None, sample, doc_id, text, values=range(count))
    known = staged(known, "sample")
    third = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    first = known.where(~third)
    listed = map_rows(first, lambda: _buckets_of, "buckets array<int>", ("doc_id", "label"))
    table = listed.select("label", F.explode("buckets").alias("bucket")).groupBy("label", "bucket").count()
    seen = np.zeros((BUCKETS, count))
    for r in table.collect():
        seen[r.bucket, r.label] = r["count"]
    texts = np.zeros(count)
    for r in first.groupBy("label").count().collect():
        texts[r.label] = r["count"]
    model = Domains(list(names), word_weights(seen, texts), np.zeros((1 + 2 * count, count)))

    def start():
        return lambda value: (model.features(value)[1].tolist(),)

    measured = map_rows(known.where(third), start, "x array<double>", ("doc_id", "label"))
    held = measured.orderBy("doc_id").collect()
    if held:
        model.curve = fit_softmax(np.array([r.x for r in held]), np.array([r.label for r in held]), count)
        model.curve[0] += _prior(labelled, known, count)
    return model


def _prior(labelled: DataFrame, sample: DataFrame, count: int) -> np.ndarray:
    """What turns the even chances of the sample into the shares that domains have among all labelled rows."""
    many = np.zeros((2, count))
    for i, rows in enumerate((labelled.where("label IS NOT NULL"), sample)):
        for r in rows.groupBy("label").count().collect():
            if 0 <= r.label < count:
                many[i, r.label] = r["count"]
    return np.log(np.maximum(many[0], 1) / np.maximum(many[1], 1))


MEMBERSHIP = "n_tokens long, posterior array<double>"


def _member(model: Domains) -> Callable:
    def start():
        def of_row(value):
            count, features = model.features(value)
            return count, model.posterior(features)

        return of_row

    return start


def memberships(df: DataFrame, model: Domains, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, posterior) of every row; the tokens are words."""
    return map_rows(picked(df, doc_id=doc_id, text=text), _member(model), MEMBERSHIP)


def _buckets_of(text: str | None) -> tuple[list[int]]:
    return (word_buckets((text or "").lower().encode().split()).tolist(),)


class Descent:
    """The steps so far: a rate is a function of them and of the posterior."""

    def __init__(self, step: float, kept: int | None = None, ridge: float = 0.0, most: float = np.inf):
        self.step = step
        self.kept = kept
        self.ridge = ridge
        self.most = most
        self.gradients: list[np.ndarray] = []
        self.momenta: list[float] = []
        self.misses: list[float] = []

    def least(self, posterior: np.ndarray) -> np.ndarray:
        """The lower bound of the rates."""
        if self.kept is None:
            return np.zeros(len(posterior))
        return (posterior[:, self.kept] >= SURE).astype(float)

    def rates(self, posterior: np.ndarray, ahead: bool = False, state: list | None = None) -> np.ndarray:
        """Rates of the rows of ``posterior``; ``ahead``: where the next gradient is taken. ``state`` is a list,
        empty at first, that saves the steps already done for the same rows."""
        done, rate, look = state or (0, np.ones(len(posterior)), np.ones(len(posterior)))
        least = self.least(posterior)
        for momentum, gradient in zip(self.momenta[done:], self.gradients[done:]):
            slope = posterior @ gradient + self.ridge * (look - 1)
            new = np.clip(look - self.step * slope, least, self.most)
            rate, look = new, np.clip(new + momentum * (new - rate), least, self.most)
        if state is not None:
            state[:] = len(self.gradients), rate, look
        return look if ahead else rate

    def rates_of_rows(self, posterior: pa.Array) -> np.ndarray:
        """Rates of a batch's rows, worked out once for each posterior there."""
        flat = posterior.flatten().to_numpy(zero_copy_only=False)
        if not len(flat):
            return np.zeros(0)
        different, place = np.unique(flat.reshape(len(posterior), -1), axis=0, return_inverse=True)
        return self.rates(different)[place.reshape(-1)]


def _here(totals: DataFrame, column: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Tokens, or another column, and posteriors on the driver, if there are few enough."""
    if not 0 < totals.count() <= HERE_ROWS:
        return None
    table = totals.select(column, "posterior").toArrow()
    flat = np.concatenate([c.flatten().to_numpy() for c in table.column("posterior").chunks])
    return table.column(column).to_numpy().astype(float), flat.reshape(table.num_rows, -1)


def _sums(
    totals: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int, column: str = "tokens"
) -> np.ndarray:
    """Sum over all rows (tokens, posterior) of a vector that ``of`` makes of a batch of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                tokens = batch.column(column).to_numpy(zero_copy_only=False).astype(float)
                posterior = np.array(batch.column("posterior").to_pylist())
                total += of(tokens, posterior)
        yield pa.RecordBatch.from_arrays([pa.array(range(size)), pa.array(total)], ["i", "x"])

    rows = map_batches(totals, run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r.i] = r.x
    return out


def dropped(totals: DataFrame, descent: Descent) -> float:
    """Share of the documents that the rates leave out."""

    def of(documents, posterior):
        return np.array([documents @ (descent.rates(posterior) <= DROPPED), documents.sum()])

    here = _here(totals, "documents")
    gone, everything = of(*here) if here else _sums(totals, of, 2, "documents")
    return float(gone / max(1.0, everything))


def descend(
    totals: DataFrame,
    targets: np.ndarray,
    kept: int | None = None,
    ridge: float = 0.0,
    most: float = np.inf,
) -> Descent:
    """Steps after which the expected tokens match ``targets``, or miss them least; ``misses`` has the
    relative miss of each target there. With ``ridge``, departures from rate 1 count too: the sum of
    (tokens missed)^2 / target has ``ridge`` * tokens * (rate - 1)^2 added to it."""
    count = len(targets)
    here = _here(totals, "tokens")
    state = [] if here else None

    def sums(of, size):
        return of(*here) if here else _sums(totals, of, size)

    weight = 1 / np.maximum(targets, 1e-9 * max(1.0, targets.sum()))

    def square(tokens, posterior):
        return ((posterior * tokens[:, None]).T @ posterior).ravel()

    matrix = sums(square, count * count).reshape(count, count)
    half = np.sqrt(weight)
    largest = float(np.linalg.eigvalsh(half[:, None] * matrix * half)[-1])
    descent = Descent(1 / (largest + ridge) if largest > 0 else 0.0, kept, ridge, most)

    def missed(ahead):
        """(relative misses, tokens by squared departure from rate 1)."""

        def expected(tokens, posterior):
            rate = descent.rates(posterior, ahead, state)
            return np.append((tokens * rate) @ posterior, tokens @ (rate - 1) ** 2)

        *reached, departed = sums(expected, count + 1)
        return (np.array(reached) - targets) * weight, departed

    def worst(miss):
        return float(np.abs(miss[targets > 0]).max(initial=0.0))

    before, last, since = np.inf, np.inf, 0
    while True:
        miss, departed = missed(ahead=True)
        loss = float((miss**2 / weight).sum()) + ridge * float(departed)
        since = 0 if loss > last else since
        descent.gradients.append(miss)
        descent.momenta.append(since / (since + 3))
        last, since = loss, since + 1
        if worst(miss) < CLOSE or not largest:
            break
        if len(descent.gradients) % ROUNDS == 0:
            if loss > before * 0.999:
                break
            before = loss
    descent.misses = missed(ahead=False)[0].tolist()
    return descent


def _target_shares(model: Domains, weights: Mapping[str, float]) -> np.ndarray:
    share = np.array([weights.get(n, 0.0) for n in model.names], float)
    return share / max(share.sum(), 1e-300)


def solved(
    placed: DataFrame,
    model: Domains,
    weights: Mapping[str, float],
    scale: float,
    tilt: bool,
    keep: str | None = None,
    most: float = np.inf,
    most_dropped: float | None = None,
) -> Descent:
    """The steps that fit the rates of the stored memberships."""
    totals = placed.groupBy("posterior").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("documents"))
    totals = staged(totals, "posteriors")
    everything = totals.agg(F.sum("tokens").alias("n")).first().n or 0
    share = _target_shares(model, weights)
    if tilt:
        share *= _sums(totals, lambda tokens, posterior: tokens @ posterior, len(share))
        share /= max(share.sum(), 1e-300)
    kept = model.names.index(keep) if keep else None
    for ridge in [0.0, *(RIDGES if most_dropped is not None else [])]:
        descent = descend(totals, share * everything * scale, kept, ridge, most)
        if most_dropped is None or dropped(totals, descent) <= most_dropped:
            break
    missed = {n: m for n, m, s in zip(model.names, descent.misses, share) if s > 0 and abs(m) > 10 * CLOSE}
    if missed and everything:
        warnings.warn(f"targets missed, relative to each: {missed}", stacklevel=3)
    return descent


def _with_column(placed: DataFrame, descent: Descent, name: str, of: Callable, kind) -> DataFrame:
    """``placed`` with a column worked out by batches from the rates; the others pass through untouched."""
    schema = StructType([*placed.schema.fields, StructField(name, kind)])
    at, names = placed.columns.index("posterior"), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = of(batch, descent.rates_of_rows(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)], names)

    return map_batches(placed, run, schema)


def rates(
    df: DataFrame,
    model: Domains,
    weights: Mapping[str, float],
    scale: float = 1.0,
    tilt: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: str | None = None,
    most: float = np.inf,
    most_dropped: float | None = None,
) -> DataFrame:
    """(doc_id, n_tokens, posterior, rate) of every row. The targets are ``weights`` (which are brought to
    sum 1) of ``scale`` times all tokens; with ``tilt`` the weights multiply the shares that the domains are
    expected to have now. The posterior is in the order of ``model.names``."""
    placed = staged(memberships(df, model, doc_id, text), "memberships")
    descent = solved(placed, model, weights, scale, tilt, keep, most, most_dropped)
    return _with_column(placed, descent, "rate", lambda _, rate: rate, DoubleType())


def report(rated: DataFrame, model: Domains, weights: Mapping[str, float], scale: float = 1.0) -> DataFrame:
    """One row for each domain (domain, target, reached, miss), with the whole table's documents, those that are
    dropped (a rate up to ``DROPPED``) and the largest rate. ``rated`` comes from ``rates`` without ``tilt``."""
    share = _target_shares(model, weights)
    names = F.array(*[F.lit(n) for n in model.names])
    shares = F.array(*[F.lit(float(s)) for s in share])
    tokens = F.col("n_tokens")
    summed = rated.agg(
        *[F.sum(tokens * F.col("rate") * F.get("posterior", F.lit(i))).alias(f"r{i}") for i in range(len(share))],
        F.sum(tokens).alias("everything"),
        F.count("*").alias("documents"),
        F.count_if(F.col("rate") <= DROPPED).alias("dropped"),
        F.max("rate").alias("largest_rate"),
    )
    reached = F.array(*[f"r{i}" for i in range(len(share))])
    each = summed.select("*", F.posexplode(names).alias("at", "domain"))
    target = F.get(shares, F.col("at")) * F.coalesce("everything", F.lit(0)) * scale
    each = each.withColumn("target", target).withColumn("reached", F.coalesce(F.get(reached, F.col("at")), F.lit(0.0)))
    miss = F.when(F.col("target") > 0, (F.col("reached") - F.col("target")) / F.col("target"))
    return each.select(
        "domain", "target", "reached", miss.alias("miss"), "documents", "dropped", "largest_rate"
    )


def mixed(
    df: DataFrame,
    model: Domains,
    weights: Mapping[str, float],
    scale: float = 1.0,
    tilt: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: str | None = None,
    most: float = np.inf,
    most_dropped: float | None = None,
) -> DataFrame:
    """The rows of ``df``, each as often as its rate says: the whole part, and once more if a hash of the
    row is below the rest, so that expected tokens match the targets. The rows are stored with their
    memberships, so no text is measured twice."""
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = [f"c{i}" for i in range(len(df.columns))]
    own = at[df.columns.index(text)]
    chance = F.pmod(F.xxhash64(at[df.columns.index(doc_id)], own), F.lit(1 << 32)) / float(1 << 32)
    asked = numbered.withColumn("chance", chance).withColumn("of", F.col(own))
    placed = staged(map_rows(asked, _member(model), MEMBERSHIP, [*at, "chance"]), "memberships")
    descent = solved(placed.select("n_tokens", "posterior"), model, weights, scale, tilt, keep, most, most_dropped)
    last = placed.columns.index("chance")

    def copies(batch: pa.RecordBatch, rate: np.ndarray) -> np.ndarray:
        return (rate + batch.column(last).to_numpy(zero_copy_only=False)).astype(np.int32)

    drawn = _with_column(placed, descent, "copies", copies, IntegerType()).where("copies > 0")
    again = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select(*at).toDF(*df.columns)
