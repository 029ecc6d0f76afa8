"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at each character. Going through the
ends in order, each place keeps the best score of a path to it and the number of tokens on that path;
no path is kept, only its count. Ties go to the piece that starts first, the longest, as in the
``tokenizers`` library's Unigram model: a later candidate must be strictly better.

A character that is no piece of its own counts as unknown, at the lowest score less ``UNKNOWN_COST``.
Unknown characters that follow one another are one token, or as many tokens as they have bytes if the
vocabulary has all byte pieces.

Before the search a space becomes the mark "▁", and the text gets one in front, as in sentencepiece
models. Scores may be any numbers; sums of them are taken from the text's beginning on in 64-bit floats, as the
library takes them, so that near ties fall as they do there. The search goes through a whole text holding no more
places than the longest piece has characters.

Where scores are whole numbers, sums are exact in any order. If then no piece has a mark behind its beginning
(both found when the vocabulary is loaded), no piece spans the place where a mark follows another character, and
the text is cut there. The cut texts are words and repeat, so their counts are remembered, at most
``CACHED_WORDS`` of at most ``CACHED_CHARS`` characters.

Defined results: a NULL or empty text has no tokens. Rows with a NULL doc_id and repeated rows count like
any other. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows, picked

MARK = "▁"
UNKNOWN_COST = 10.0
CACHED_WORDS = 500_000
CACHED_CHARS = 64

_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_loaded: dict[str, "Counter"] = {}


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, by id; control pieces have no score of their own."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts tokens of a text under a vocabulary of (piece, score), of which ``unknown`` is no piece."""

    def __init__(self, pieces: Iterable[tuple[str, float]], unknown: int = 0):
        pieces = list(pieces)
        names = {piece for piece, _ in pieces}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown_piece = pieces[unknown][0]
        self.unknown_score = min(score for _, score in pieces) - UNKNOWN_COST
        self.automaton = ahocorasick.Automaton()
        self.by_word = all(MARK not in p.lstrip(MARK) and float(score).is_integer() for p, score in pieces)
        self.longest = max(len(piece) for piece, _ in pieces)
        for i, (piece, score) in enumerate(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, i == unknown))
        self.automaton.make_automaton()
        self.counts: dict[str, int] = {}

    @classmethod
    def at(cls, path: str) -> Counter:
        """Loaded once in a Python worker."""
        if path not in _loaded:
            _loaded[path] = cls(vocabulary(path))
        return _loaded[path]

    def word(self, word: str) -> int:
        """Tokens on the best path through a text without a cut in it.

        A place holds the score, the tokens before an unknown run that ends there, and the length of
        that run in characters.
        """
        size = len(word)
        scores: list[float | None] = [None] * (size + 1)
        tokens = [0] * (size + 1)
        runs = [0] * (size + 1)
        scores[0] = 0.0
        single = [False] * size
        ending: list[list[tuple[int, float, bool]]] = [[] for _ in range(size)]
        for end, found in self.automaton.iter(word):
            ending[end].append(found)
            if found[0] == 1:
                single[end] = True
        for end in range(1, size + 1):
            # the automaton lists the longest piece first, so the earliest start comes first
            for length, score, unknown in ending[end - 1]:
                start = end - length
                reached = scores[start] + score
                if scores[end] is None or reached > scores[end]:
                    scores[end] = reached
                    if unknown:
                        tokens[end], runs[end] = tokens[start], runs[start] + length
                    else:
                        tokens[end], runs[end] = tokens[start] + self.run(word, start, runs[start]) + 1, 0
            if not single[end - 1]:
                reached = scores[end - 1] + self.unknown_score
                if scores[end] is None or reached > scores[end]:
                    scores[end] = reached
                    tokens[end], runs[end] = tokens[end - 1], runs[end - 1] + 1
        return tokens[size] + self.run(word, size, runs[size])

    def whole(self, text: str) -> int:
        """Tokens on the best path through a text of any length, with sums from its beginning on.

        Places are kept in rings that hold as many as the longest piece has characters.
        """
        ring = self.longest + 1
        scores: list[float | None] = [None] * ring
        tokens, runs, run_bytes = [0] * ring, [0] * ring, [0] * ring
        scores[0] = 0.0
        pieces: list[tuple[int, float, bool]] = []
        ends = self.automaton.iter(text)
        at, found = next(ends, (-1, None))
        for end in range(1, len(text) + 1):
            pieces.clear()
            while at == end - 1:
                pieces.append(found)
                at, found = next(ends, (-1, None))
            here, best, single = end % ring, None, False
            for length, score, unknown in pieces:
                start = (end - length) % ring
                single = single or length == 1
                reached = scores[start] + score
                if best is None or reached > best:
                    best = reached
                    if unknown:
                        tokens[here], runs[here] = tokens[start], runs[start] + length
                        run_bytes[here] = run_bytes[start] + len(text[end - length : end].encode())
                    else:
                        closed = self.closed(text, end - length, runs[start], run_bytes[start])
                        tokens[here], runs[here], run_bytes[here] = tokens[start] + closed + 1, 0, 0
            if not single:
                start = (end - 1) % ring
                reached = scores[start] + self.unknown_score
                if best is None or reached > best:
                    best = reached
                    tokens[here], runs[here] = tokens[start], runs[start] + 1
                    run_bytes[here] = run_bytes[start] + len(text[end - 1].encode())
            scores[here] = best
        last = len(text) % ring
        return tokens[last] + self.closed(text, len(text), runs[last], run_bytes[last])

    def closed(self, text: str, end: int, length: int, size: int) -> int:
        """Tokens of the unknown run of so many characters and bytes that ends at ``end``."""
        if not length:
            return 0
        own = length == len(self.unknown_piece) and text[end - length : end] == self.unknown_piece
        return 1 if own or not self.bytes else size

    def run(self, word: str, end: int, length: int) -> int:
        """Tokens of the unknown run that ends at ``end``."""
        if not length:
            return 0
        text = word[end - length : end]
        if text == self.unknown_piece or not self.bytes:
            return 1
        return len(text.encode())

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self.whole(MARK + text.replace(" ", MARK))
        total = 0
        known = self.counts
        for word in _WORD.findall(MARK + text.replace(" ", MARK)):
            found = known.get(word)
            if found is None:
                found = self.word(word)
                if len(word) <= CACHED_CHARS:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    known[word] = found
            total += found
        return total


def count_tokens(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row."""

    def start():
        counter = Counter.at(path)
        return lambda value: (counter.count(value),)

    return map_rows(picked(df, doc_id=doc_id, text=text), start, "n_tokens long")
