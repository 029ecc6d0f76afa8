"""Measures against regular expressions, and every count against all orders applied to plain lists."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.cases import DOCUMENTS, EDGE_ROWS, row
from tidemark.llm import filter_audit
from tidemark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_measures(text):
    words = WORD.findall(text)
    capitals, symbols = len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text))
    return len(words), len(set(words)), capitals, len(text), symbols


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x1c\x85 aAbZ#|é日🙂\x00", max_size=60))
def test_measures(text):
    assert filter_audit.measure(text.encode()) == plain_measures(text)


def test_stretches_carry_the_state(monkeypatch):
    texts = ["", " ", "one", "one two  one", "ÄB " * 7 + "x", "\n a#b ", "日本語 日本 語"]
    for size in (1, 2, 3, 5):
        monkeypatch.setattr(filter_audit, "STRETCH", size)
        for text in texts:
            assert filter_audit.measure(text.encode()) == plain_measures(text)


def plain(rows, labels):
    """{(part, order, step): counts} of (doc_id, text, lang), by applying every order."""
    rows = [(i, t or "", p or "") for i, t, p in rows]
    holders = defaultdict(set)
    for i, t, _ in rows:
        holders[t].add((i is None, i or 0))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failing = []
    for i, t, p in rows:
        words, different, capitals, points, symbols = plain_measures(t)
        fails = {
            "A": words < 100,
            "B": 100 * different < 80 * words,
            "C": 100 * capitals > 10 * points,
            "D": symbols > 0,
            "E": min(holders[t]) < (i is None, i or 0),
        }
        failing.append((p, {k for k, v in fails.items() if v}, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in failing}:
        own = [f[1:] for f in failing if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                fail = [f for f in own if letter in f[0]]
                gone = [f for f in left if letter in f[0]]
                left = [f for f in left if letter not in f[0]]
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    len(fail) - len(gone),
                    sum(f[0] == {letter} for f in fail),
                    sum(f[1] for f in gone),
                    sum(f[2] for f in gone),
                ]
                shapley[part, letter] += len(gone)
    return {(p, o, s): [*v, shapley[p, o[s - 1]]] for (p, o, s), v in out.items()}


def got(df):
    return {(r.part, r.filter_order, r.step): [r[c] for c in COLUMNS] for r in df.collect()}


LABELS = "doc_id long, quality int, toxic int"


def test_documents(spark, small, docs):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    expected = plain(
        [(r.doc_id, r.text, r.lang) for r in docs.collect()],
        [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()],
    )
    out = QUERIES["op12_filter_audit"](spark, small)
    assert got(out) == expected
    assert dict(out.dtypes)["step"] == "int" and all(dict(out.dtypes)[c] == "bigint" for c in COLUMNS)
    assert any(v[2] for v in expected.values()) and any(v[4] for v in expected.values())


def test_edge_rows_copies_and_labels(spark, edge, nothing):
    labels = [(1, 1, None), (1, 0, 1), (2, None, 1), (None, 1, 1), (6, 1, 0), (99, 1, 1)]
    expected = plain([(r[0], r[1], r[2]) for r in EDGE_ROWS], labels)
    given_labels = spark.createDataFrame(labels, LABELS)
    assert got(filter_audit.audit(edge, given_labels)) == expected
    assert {p for p, _, _ in expected} == {"", "en"} and len(expected) == 2 * 600
    assert filter_audit.audit(nothing, given_labels).count() == 0


def test_one_group_of_copies_over_several_parts(spark):
    many = " ".join(f"w{i}" for i in range(120))
    rows = [row(i, many, ["en", "fr", None][i % 3]) for i in range(500)]
    rows += [row(0, many, "de"), row(900, many + " #", "en"), row(901, "", None), row(902, None, "fr")]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 500, 3)]
    labels = [(i, q, int(t)) for i, q, t in labels]
    expected = plain([(r[0], r[1], r[2]) for r in rows], labels)
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(7)
    assert got(filter_audit.audit(df, spark.createDataFrame(labels, LABELS))) == expected


@pytest.mark.parametrize("kind", ["string", "int"])
def test_any_id_type(spark, kind):
    df = spark.createDataFrame([("2", "x"), ("10", "x"), (None, "x")], "doc_id string, text string")
    df = df.selectExpr(f"cast(doc_id as {kind}) doc_id", "text", "'en' lang")
    labels = spark.createDataFrame([], f"doc_id {kind}, quality int, toxic int")
    out = filter_audit.audit(df, labels).where("filter_order = 'EABCD' AND step = 1").collect()
    assert [(r.kept, r.removed) for r in out] == [(1, 2)]
