"""Fingerprints bit by bit, links and components by comparing all pairs."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm.cases import EDGE_ROWS
from tidemark.llm import simhash
from tidemark.llm.components import smallest_reachable


def slow_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(marks):
    """{index: smallest index reachable} over all pairs."""
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(marks))]


def _expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    marks = [slow_fingerprint(text) for _, text in rows]
    roots = slow_components(marks)
    return sorted(
        repr((rows[i][0], f"{marks[i]:016x}", rows[roots[i]][0])) for i in range(len(rows))
    )


def test_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = simhash.near_duplicates(docs)
    assert sorted(repr(tuple(r)) for r in got.collect()) == _expected(rows)


def test_edge_rows(edge, nothing):
    got = simhash.near_duplicates(edge)
    assert sorted(repr(tuple(r)) for r in got.collect()) == _expected([r[:2] for r in EDGE_ROWS])
    assert simhash.near_duplicates(nothing).count() == 0


def _clustered(size):
    """Fingerprints around centres, with chains at the largest distance and a tight crowd."""
    rng = random.Random(7)
    marks = [rng.getrandbits(64) for _ in range(size)]
    crowd = rng.getrandbits(64)
    for _ in range(size):
        marks.append(crowd ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    for start in marks[:40]:
        for _ in range(6):
            start ^= sum(1 << b for b in rng.sample(range(64), 4))
            marks.append(start)
    return sorted(set(marks))


def test_links_join_what_all_pairs_join(spark, monkeypatch):
    """Small shards and leaves, so that borders, local trees and cut shards all come into play."""
    monkeypatch.setattr(simhash, "SHARD_SIZE", 8)
    monkeypatch.setattr(simhash, "LEAF_SIZE", 4)
    marks = _clustered(600)
    signed = np.array(marks, np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(m,) for m in signed], "bits long")
    links = simhash.close_groups(distinct)
    parts = smallest_reachable(links).collect()
    got = {r.node: r.root for r in parts}
    ours, theirs = {}, {}
    for mark, root in zip(signed, slow_components(marks)):
        ours.setdefault(got.get(mark, mark), set()).add(mark)
        theirs.setdefault(root, set()).add(mark)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = smallest_reachable(links.unionByName(links)).collect()
    assert {r.root for r in got} == {0} and len(got) == 200
