"""BPE against the library's own encode and decode."""

import hashlib
import tracemalloc

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.cases import EDGE_ROWS
from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _same(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text("abethAΣ'sdl1 ½é́.<|endofx>\n\x1c\x85", max_size=80))
def test_any_text(text):
    ours, theirs = bpe.Bpe.at(PATH), _library()
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def _library(cache=[]):
    if not cache:
        cache.append(Tokenizer.from_file(PATH))
    return cache[0]


def test_documents_and_round_trip(library, docs):
    got = bpe.encode_decode(docs, PATH).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    for r in got:
        assert (r.ids, r.decoded) == _same(library, texts[r.doc_id])
    again = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert {(r.doc_id, r.decoded) for r in again.collect()} == {(r.doc_id, r.decoded) for r in got}


def test_edge_rows(library, edge, nothing):
    got = bpe.encode_decode(edge, PATH).collect()
    expected = [(r[0], *_same(library, r[1])) for r in EDGE_ROWS]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert bpe.encode_decode(nothing, PATH).count() == 0


def test_words_forgotten_when_full(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    ours = bpe.Bpe(PATH)
    text = "some words that are more than three and some words again"
    assert ours.encode(text) == _library().encode(text, add_special_tokens=False).ids
    assert len(ours.words) <= 3


def test_every_character():
    """Beside a letter, a digit and a symbol, so that every class and every case is seen."""
    ours, theirs = bpe.Bpe.at(PATH), _library()
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 0 or c < 0x3000]
    texts = ["".join(f"a{c}:{c}1 " for c in characters[i : i + 500]) for i in range(0, len(characters), 500)]
    for text, coded in zip(texts, theirs.encode_batch(texts, add_special_tokens=False)):
        assert ours.encode(text) == coded.ids


def test_words_remembered_fit_in_a_worker():
    """Two workers' words and two counts of the JVM are to fit in an executor."""
    ours, n = bpe.Bpe(PATH), 20_000
    tracemalloc.start()
    try:
        for i in range(n):
            ours.encode(chr(0x4E00 + i % 20_000) + "word")
        size = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(ours.words) + len(ours.words.older) >= n
    assert bpe.CACHED_WORDS * size / n < 80e6


def test_query_over_edge_rows(library, edge, tmp_path):
    """Digests as from the library, without an array of strings on the way: that is some objects for every token."""
    edge.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op8_bpe"](edge.sparkSession, str(tmp_path))
    expected = []
    for r in EDGE_ROWS:
        ids, decoded = _same(library, r[1])
        hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        expected.append((r[0], len(ids), *hashes))
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, expected))
    assert "array<string>" not in out._jdf.queryExecution().optimizedPlan().toString()
