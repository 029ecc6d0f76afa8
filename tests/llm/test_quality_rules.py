"""Counts and verdicts against plain loops over the texts."""

import re
from collections import Counter, defaultdict

import pytest

from llm.cases import EDGE_ROWS, row
from tidemark.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeats = len(lines) - len(set(lines))
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, repeats, len(covered), failed


def normal(line):
    return " ".join(WORD.findall(line.lower()))


def plain(rows, least_limit, max_share, least_left):
    """(doc_id, counts, base_failed, kept, removed_words) of (doc_id, text, host), by brute force."""
    found, hosts = defaultdict(set), defaultdict(set)
    for doc_id, text, host in rows:
        hosts[host].add((doc_id, text))
        for line in filter(None, map(normal, (text or "").split("\n"))):
            found[host, line].add((doc_id, text))
    over = {
        k for k, v in found.items() if len(v) > least_limit and len(v) > len(hosts[k[0]]) * max_share
    }
    holders = defaultdict(set)
    for doc_id, text, host in rows:
        for line in filter(None, map(normal, (text or "").split("\n"))):
            if (host, line) in over:
                holders[host, line].add((doc_id is None, doc_id or 0, text))
    out = []
    for doc_id, text, host in rows:
        *counts, failed = base(text)
        lost = 0
        for line in (text or "").split("\n"):
            key = (host, normal(line))
            if key in over and min(holders[key]) != (doc_id is None, doc_id or 0, text):
                lost += len(WORD.findall(line))
        left = counts[0] - lost
        depleted = lost and (left < 20 or left < counts[0] * least_left)
        out.append((doc_id, *counts, failed, not failed and not depleted, lost))
    return sorted(map(repr, out))


def got(df, **limits):
    return sorted(repr(tuple(r)) for r in quality_rules.verdicts(df, **limits).collect())


def test_documents(docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got(docs) == plain(rows, quality_rules.LEAST_LIMIT, quality_rules.MAX_SHARE, 0.2)
    assert got(docs, least_limit=1, max_share=0.0) == plain(rows, 1, 0.0, 0.2)


def test_edge_rows(edge, nothing):
    rows = [(r[0], r[1], r[3]) for r in EDGE_ROWS]
    assert got(edge) == plain(rows, quality_rules.LEAST_LIMIT, quality_rules.MAX_SHARE, 0.2)
    assert quality_rules.verdicts(nothing).count() == 0
    assert quality_rules.apply_rules(nothing).count() == 0


@pytest.fixture(scope="module")
def site(spark):
    own = ["", "Every document has words of its own, number {i}, and they go on for a while {i} {i} so that "]
    body = own[1] + "enough of them are left {i} after the lines that all share are gone, more {i} or less."
    shared = "Subscribe  NOW to our letter and read it every day of the week\n"
    many = "\n".join(" ".join(f"w{k}x{j}" for j in range(9)) for k in range(40))
    rows = [row(i, shared + body.format(i=i), source="a") for i in range(8)]
    rows += [row(20 + i, many + f"\nown {i}", source="b") for i in range(8)]
    rows += [row(40 + i, shared + body.format(i=9), source="c") for i in range(8)]
    return rows


def test_shared_lines_go_and_depleted_documents_too(spark, site):
    from llm.cases import DOCUMENTS

    df = spark.createDataFrame(site, DOCUMENTS)
    limits = {"least_limit": 3, "max_share": 0.1}
    rows = [(r[0], r[1], r[3]) for r in site]
    assert got(df, **limits) == plain(rows, 3, 0.1, 0.2)
    out = quality_rules.apply_rules(df, **limits)
    assert out.columns == df.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert [i for i in range(8) if "Subscribe" in texts[i]] == [0]
    assert [i for i in range(20, 28) if i in texts] == [20]
    # copies are documents too: all but the first lose the line, and here all of their lines
    assert [i for i in range(40, 48) if i in texts] == [40]


def test_the_limit_does_not_grow_with_the_host(spark):
    shared = "This line stands in only ninety nine of the many documents here"
    rows = [row(i, f"{prose(i)}\n{shared if i % 50 == 0 and i < 4950 else ''}", source="big") for i in range(5000)]
    copy = f"{prose(-1)}\nThree hundred copies of one text have this line in them, too"
    rows += [row(10_000 + i, copy, source="copies") for i in range(300)]
    df = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r.text for r in quality_rules.apply_rules(df).collect()}
    assert [i for i in range(0, 5000) if shared in out[i]] == [0]
    assert [i for i in out if i >= 10_000] == [10_000]


def prose(i):
    return " ".join(f"w{i}x{k}" for k in range(30))


def test_columns_with_the_names_used_inside(spark, site):
    names = ["_lines", "_kept", "_of_id", "_of_key", "_of_host", "_made", "_text", "kept", "left", "c0", "of_id"]
    df = spark.createDataFrame([r[:4] for r in site], "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    clashing = df.withColumns({n: F.lit(7) for n in names})
    out = quality_rules.apply_rules(clashing, least_limit=3)
    assert out.columns == clashing.columns
    plainly = quality_rules.apply_rules(df, least_limit=3)
    assert sorted(map(tuple, out.select(df.columns).collect())) == sorted(map(tuple, plainly.collect()))
    assert {tuple(r[n] for n in names) for r in out.collect()} == {(7,) * len(names)}
