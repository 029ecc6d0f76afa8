"""Secrets by a trigram inverted index: Boolean trigram queries from the rules' patterns, then verified candidates.

A rule is a pattern, the group whose length counts, and the least length. From the pattern's parse tree a
Boolean query over trigrams is derived that every match must satisfy: literals that stand side by side form
words, a word asks for all of its trigrams, alternatives are joined by "any". Optional parts, long repeats and
large classes ask for nothing. Trigrams are of UTF-8 bytes with A-Z lower-cased, so one index serves rules in
either case; patterns are read in ASCII mode, where letters have no other case.

The index is cut into blocks of documents, one after another in a task. A block's postings (trigram ->
documents) hold the trigrams that any rule asks for. Each rule intersects and unites postings, and only the
documents left are searched by its pattern. A rule without a mandatory trigram searches every document. No text
is shuffled, a block is forgotten once it is answered, and a lost task is run again alone.

Matches are leftmost and do not overlap within a rule; those that are too short are dropped after they were
matched, so they still use up their text. Positions are code points, the end exclusive.

Defined results: a NULL or empty text has no spans. Rows equal in everything, or only in doc_id, each get their
own answer; a NULL doc_id stays NULL. Spans that start together come in the order of the rules. Other columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.llm.common import map_batches, picked

# Documents of a block, and bytes whose trigrams are looked at together.
BLOCK_ROWS = 256
WINDOW_BYTES = 1 << 22
# Words followed side by side, and characters of a class that are spelled out.
MAX_WORDS = 64
MAX_CLASS = 16


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The base kinds. A run of hex digits is one match, so its least length can stand in the pattern.
BASE = [
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
        any_case=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),
]
# Public formats of keys and tokens.
MORE = [
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]+", 26),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("url_login", r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]+:([^\s/:@]+)@", 3, 1),
]
RULES = [*BASE, *MORE]


# Queries. None is satisfied by every document, bytes are a trigram, the others are all or any of their parts.


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any:
    parts: tuple


Query = All | Any | bytes | None


def all_of(parts: Iterable[Query]) -> Query:
    asked = tuple(dict.fromkeys(p for p in parts if p is not None))
    return None if not asked else asked[0] if len(asked) == 1 else All(asked)


def any_of(parts: Iterable[Query]) -> Query:
    asked = tuple(dict.fromkeys(parts))
    if not asked or None in asked:
        return None
    return asked[0] if len(asked) == 1 else Any(asked)


def of_words(words: set[str]) -> Query:
    """One of the words occurs: all trigrams of any of them. A word whose trigrams hold another's adds nothing."""
    sets = {frozenset(w.encode()[i : i + 3] for i in range(len(w.encode()) - 2)) for w in words}
    least = [s for s in sets if not any(other < s for other in sets)]
    return any_of(all_of(sorted(s)) for s in sorted(least, key=sorted))


@dataclass(frozen=True)
class Seen:
    """What a part of a pattern matches: exactly one of ``words``, or anything that satisfies ``query``."""

    words: frozenset | None
    query: Query = None

    def asked(self) -> Query:
        return self.query if self.words is None else of_words(self.words)


ANYTHING = Seen(None)
NOTHING = Seen(frozenset([""]))


def _class_of(members) -> Seen:
    letters: set[str] = set()
    for kind, value in members:
        if kind is op.LITERAL:
            codes: Iterable[int] = [value]
        elif kind is op.RANGE and value[1] - value[0] < 128:
            codes = range(value[0], value[1] + 1)
        else:
            return ANYTHING
        letters |= {chr(c).lower() if c < 128 else "" for c in codes}
    return Seen(frozenset(letters)) if "" not in letters and len(letters) <= MAX_CLASS else ANYTHING


def _joined(left: frozenset, right: frozenset) -> frozenset | None:
    return frozenset(a + b for a in left for b in right) if len(left) * len(right) <= MAX_WORDS else None


def _in_a_row(parts: Iterable[Seen]) -> Seen:
    """Parts side by side; where words can no longer be followed, those so far are asked for."""
    asked: list[Query] = []
    words, whole = NOTHING.words, True
    for part in parts:
        longer = _joined(words, part.words) if part.words is not None else None
        if longer is not None:
            words = longer
            continue
        asked += [of_words(words), part.query]
        words, whole = (part.words or NOTHING.words), False
    if whole:
        return Seen(words)
    return Seen(None, all_of([*asked, of_words(words)]))


def _repeated(least: int, most: int, part: Seen) -> Seen:
    if least == 0:
        return Seen(part.words | {""}) if most == 1 and part.words is not None else ANYTHING
    row = _in_a_row([part] * min(least, MAX_WORDS))
    return row if least == most and least <= MAX_WORDS else Seen(None, row.asked())


def _part(kind, value) -> Seen:
    if kind is op.LITERAL:
        return Seen(frozenset([chr(value).lower()])) if value < 128 else ANYTHING
    if kind is op.IN:
        return _class_of(value)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        return _repeated(value[0], value[1], _parts(value[2]))
    if kind is op.SUBPATTERN:
        return _parts(value[3])
    if kind is op.ATOMIC_GROUP:
        return _parts(value)
    if kind is op.BRANCH:
        ways = [_parts(way) for way in value[1]]
        if all(w.words is not None for w in ways):
            words = frozenset().union(*[w.words for w in ways])
            if len(words) <= MAX_WORDS:
                return Seen(words)
        return Seen(None, any_of(w.asked() for w in ways))
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return NOTHING
    return ANYTHING


def _parts(parsed) -> Seen:
    return _in_a_row(_part(kind, value) for kind, value in parsed)


def trigram_query(rule: Rule) -> Query:
    """What every text with a match of the rule has; None if there is no trigram it must have."""
    return _parts(_parser.parse(rule.pattern, rule.compiled().flags)).asked()


def trigrams_of(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(trigrams_of, query.parts)) if query is not None else set()


# Postings of a block.

_NONE = np.zeros(0, np.int64)


def _code(trigram: bytes) -> int:
    return int.from_bytes(trigram, "big")


class Index:
    """Postings of one block of texts for the trigrams that the queries ask for."""

    def __init__(self, texts: Sequence[str], wanted: np.ndarray):
        folded = [t.encode().lower() for t in texts]
        # 0xFF is in no UTF-8 text, so no trigram asked for spans two texts
        whole = b"\xff".join(folded)
        starts = np.cumsum([0, *[len(t) + 1 for t in folded[:-1]]])
        self.rows = np.arange(len(texts))
        found = []
        for at in range(0, max(0, len(whole) - 2), WINDOW_BYTES):
            window = np.frombuffer(whole, np.uint8, min(WINDOW_BYTES + 2, len(whole) - at), at)
            codes = (window[:-2].astype(np.int32) << 16) | (window[1:-1].astype(np.int32) << 8) | window[2:]
            hits = np.flatnonzero(wanted[codes])
            rows = np.searchsorted(starts, hits + at, "right") - 1
            found.append(np.unique(codes[hits].astype(np.int64) * len(texts) + rows))
        pairs = np.unique(np.concatenate(found)) if found else _NONE
        trigrams, first = np.unique(pairs // max(1, len(texts)), return_index=True)
        self.postings = dict(zip(trigrams.tolist(), np.split(pairs % max(1, len(texts)), first[1:])))

    def matching(self, query: Query) -> np.ndarray:
        """Numbers of the texts that satisfy the query, in order."""
        if query is None:
            return self.rows
        if isinstance(query, bytes):
            return self.postings.get(_code(query), _NONE)
        parts = [self.matching(part) for part in query.parts]
        if isinstance(query, All):
            return reduce(lambda a, b: np.intersect1d(a, b, True), sorted(parts, key=len))
        return reduce(np.union1d, parts)


class Scanner:
    """Rules with their queries, for one block of texts after another."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(rule, rule.compiled(), trigram_query(rule)) for rule in rules]
        self.wanted = np.zeros(1 << 24, bool)
        for _, _, query in self.rules:
            for trigram in trigrams_of(query):
                self.wanted[_code(trigram)] = True

    def spans(self, texts: Sequence[str]) -> list[list[tuple[str, int, int]]]:
        index = Index(texts, self.wanted)
        found: list[list] = [[] for _ in texts]
        for place, (rule, pattern, query) in enumerate(self.rules):
            for row in index.matching(query).tolist():
                for match in pattern.finditer(texts[row]):
                    if len(match[rule.group] or "") >= rule.least:
                        found[row].append((match.start(), place, match.end()))
        return [[(self.rules[p][0].kind, s, e) for s, p, e in sorted(spans)] for spans in found]


SPANS = "array<struct<kind:string, start:long, end:long>>"


def find_secrets(
    df: DataFrame, rules: Sequence[Rule] = tuple(RULES), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, spans) of every row: the spans of all rules, by start and then in the order of the rules."""
    rows = picked(df, doc_id=doc_id, text=text)
    made = df.sparkSession.createDataFrame([], f"spans {SPANS}").schema
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                block = batch.slice(at, BLOCK_ROWS)
                texts = [t or "" for t in block.column("text").to_pylist()]
                spans = pa.array(scanner.spans(texts), kinds)
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), spans], ["doc_id", "spans"])

    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), *made.fields])
    return map_batches(rows, run, schema)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(list(kinds)))
