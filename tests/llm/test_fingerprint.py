"""Multiset hash: order, insertion, deletion; the next document by plain sorting."""

import hashlib
import math
import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.cases import EDGE_ROWS
from tidemark.llm import fingerprint
from tidemark.llm.fingerprint import Fingerprint

LINES = st.lists(st.text("ab c.,é", max_size=12), min_size=1, max_size=8)


@settings(max_examples=100, deadline=None)
@given(lines=LINES, more=LINES, seed=st.integers(0, 99))
def test_order_insertion_deletion(lines, more, seed):
    mixed = random.Random(seed).sample(lines + more, len(lines + more))
    whole = Fingerprint.of_paragraphs(mixed).hex()
    part = Fingerprint.of_paragraphs(lines).hex()
    assert fingerprint.inserted(part, *more) == whole
    assert fingerprint.deleted(whole, *more) == part
    assert Fingerprint.from_hex(whole).likeness(Fingerprint.of_paragraphs(lines + more)) == 1.0


def plain_lanes(text):
    """Both kinds of lanes, written out: hashes of paragraphs and signs of clauses, added one by one."""
    exact, near = [0] * 8, [0] * 128
    for paragraph in text.split("\n") if text else []:
        digest = hashlib.blake2b(paragraph.encode(), digest_size=64).digest()
        for i in range(8):
            exact[i] = (exact[i] + int.from_bytes(digest[8 * i : 8 * i + 8], "little")) % 2**64
        for clause in re.findall(r"[^.,;:!?|]{1,80}", paragraph):
            bits = int.from_bytes(xxhash.xxh3_128_digest(clause.encode()), "big")
            for i in range(128):
                near[i] += 1 if bits >> (127 - i) & 1 else -1
    return exact, near


def plain_hex(text):
    exact, near = plain_lanes(text)
    return b"".join([*(x.to_bytes(8, "little") for x in exact), *((x % 2**32).to_bytes(4, "little") for x in near)]).hex()


def plain_likeness(one, other):
    (exact, a), (other_exact, b) = plain_lanes(one), plain_lanes(other)
    if exact == other_exact:
        return 1.0
    size = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
    return min(1.0, max(0.0, sum(x * y for x, y in zip(a, b)) / size)) if size else 0.0


@settings(max_examples=60, deadline=None)
@given(st.text("ab c.,é\n", max_size=40), st.text("ab c.,é\n", max_size=40))
def test_lanes_as_written_out(one, other):
    assert Fingerprint.of(one).hex() == plain_hex(one)
    assert Fingerprint.of(one).likeness(Fingerprint.of(other)) == pytest.approx(plain_likeness(one, other), abs=1e-9)


def test_likeness_of_very_long_texts():
    clause = "the same clause again."
    some, more, other = (Fingerprint.of(text) for text in (clause * 20_000, clause * 40_000, "another one." * 40_000))
    assert some.likeness(more) == pytest.approx(1.0) and some.likeness(other) < 0.4
    assert (some + some).likeness(more) == pytest.approx(1.0)
    assert Fingerprint.from_hex(more.hex()).likeness(more) == 1.0


def test_string_ids_and_no_window_over_everything(spark):
    rows = [("b", "two. words"), ("a", "one"), (None, "last"), ("c", "three")]
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    got = fingerprint.with_next(df)
    check(df, rows)
    assert dict(got.dtypes)["doc_id"] == "string"
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def expected(rows, keys):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or type(r[0])() if r[0] is not None else 0, keys[r[1]]))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        out.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                Fingerprint.of(text).hex(),
                Fingerprint.of(edited).hex(),
                Fingerprint.of(text).likeness(Fingerprint.of(edited)),
                Fingerprint.of(text).likeness(Fingerprint.of(following)),
            )
        )
    return sorted(map(repr, out))


def check(df, rows):
    keys = {r.text: r.k for r in df.select("text", F.xxhash64("text").alias("k")).collect()}
    got = fingerprint.with_next(df)
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(rows, keys)
    return got


def test_documents_over_many_tasks(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = check(docs.repartition(5), rows)
    near = got.agg(F.avg("near_edited"), F.avg("near_next"), F.count("*")).first()
    assert near[0] > 0.3 > 0.1 > near[1]


def test_edge_rows(spark, edge, nothing):
    check(edge, [r[:2] for r in EDGE_ROWS])
    assert fingerprint.with_next(nothing).count() == 0
    one = edge.where("doc_id = 6")
    assert fingerprint.with_next(one).first().near_next == 1.0


def test_one_paragraph_changed(docs):
    text = max((r.text for r in docs.collect()), key=lambda t: t.count("\n"))
    lines = text.split("\n")
    other = Fingerprint.of("\n".join(["An entirely new paragraph, of its own.", *lines[1:]]))
    assert 0.7 < Fingerprint.of(text).likeness(other) < 1.0


def test_fingerprints(docs):
    got = fingerprint.fingerprints(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.fingerprint == Fingerprint.of(texts[r.doc_id]).hex() for r in got)
    assert len(got) == len(texts)
