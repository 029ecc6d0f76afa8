"""Templates on hand-made lines; the full result is compared with SQL in test_oracle."""

import random

import pytest
from pyspark.sql import functions as F

from llm.cases import DOCUMENTS, EDGE_ROWS, row
from tidemark.llm import line_dedup

BODY = "Document {i} alone says {w} here and nothing else does so at all"


def test_variable_fields_and_first_document(spark):
    rows = []
    for i, name in enumerate(["ann", "bob", "cid", "dan"]):
        lines = [
            f"Posted on 2024-01-0{i} by user {name} in the general news section of this site",
            f"Only {name} wrote this particular line " + " ".join(f"{name}{chr(97 + k)}" for k in range(6)),
            "",
            "All  rights reserved.",
        ]
        rows.append(row(10 - i, "\n".join(lines)))
    got = {r.doc_id: r for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert [got[i].n_dropped for i in (7, 8, 9, 10)] == [0, 2, 2, 2]
    assert got[7].text == rows[3][1]
    assert got[9].text == "\n".join(rows[1][1].split("\n")[1:3])
    assert all(r.n_lines == 4 for r in got.values())


def test_short_lines_need_three_documents_and_repeats_within_one_are_none(spark):
    line = "The same few words stand in this line"
    rows = [row(1, f"{line}\n{line}\n{line}"), row(2, line)]
    got = line_dedup.deduplicated(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert all(r.n_dropped == 0 for r in got)
    more = line_dedup.deduplicated(spark.createDataFrame([*rows, row(3, line)], DOCUMENTS)).collect()
    assert {r.doc_id: r.n_dropped for r in more} == {1: 0, 2: 1, 3: 1}


def test_a_long_line_recurs_from_two_documents_on(spark):
    passage = " ".join(f"{a}{b}" for a in "klmnop" for b in "aeiouyrstv")
    other = passage.replace("ka ke", "ka x e")
    rows = [row(4, f"own words of four\n{passage}"), row(9, f"  {passage.replace(' ', '  ')}\nand nine"), row(11, other)]
    got = {r.doc_id: r for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert (got[4].n_dropped, got[9].n_dropped, got[11].n_dropped) == (0, 1, 0)
    assert got[9].text == "and nine" and got[4].text == rows[0][1]


def templated(count, values=1000):
    """Lines of one template with two fields of many words each, one to a document."""
    rng = random.Random(count)

    def word():
        n = rng.randrange(values)
        return "".join("bcdfghjklm"[int(d)] + "a" for d in f"{n:03d}")

    return [row(i, f"The user {word()} has kindly sent {word()} to this open board today") for i in range(count)]


@pytest.mark.parametrize("count", [100, 1000, 10_000])
def test_the_verdict_on_a_field_does_not_change_with_the_number_of_lines(spark, count):
    df = spark.createDataFrame(templated(count), DOCUMENTS)
    # the leading tokens hold the first field, so a leaf is made by its value; the board's lines have none there
    moved = df.withColumn("text", F.regexp_replace("text", "^The user", "Dear reader, the user"))
    got = line_dedup.deduplicated(moved).agg(F.sum("n_dropped"), F.min("n_dropped")).first()
    assert tuple(got) == (count - 1, 0)


def test_lines_of_numbers_recur_only_as_they_are(spark):
    lines = [f"{i} {i * 7} {i + 1}" for i in range(12)] + [f"{i},5 x {i} 2024-01-{i:02d}" for i in range(12)]
    rows = [row(i, f"{line}\n1 2 3") for i, line in enumerate(lines)]
    got = {r.doc_id: r for r in line_dedup.deduplicated(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert got[0].n_dropped == 0
    assert all(got[i].text == lines[i] and got[i].n_dropped == 1 for i in range(1, 24))


def test_edge_rows(edge, nothing):
    got = line_dedup.apply(edge)
    assert got.columns == edge.columns
    kept = sorted(repr((r.doc_id, r.text)) for r in line_dedup.apply(edge, min_documents=99).collect())
    assert kept == sorted(repr(r[:2]) for r in EDGE_ROWS)
    texts = {repr(r.doc_id): r.text for r in got.collect()}
    # the three lines of the same prose stay in document 1 alone
    assert texts["1"] == EDGE_ROWS[0][1] and texts["2"] == "" and texts["4"] is None
    assert line_dedup.apply(nothing).count() == 0


def test_beyond_the_broadcast_bound(spark, docs, monkeypatch):
    few = sorted(map(repr, map(tuple, line_dedup.deduplicated(docs).collect())))
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    assert sorted(map(repr, map(tuple, line_dedup.deduplicated(docs).collect()))) == few
