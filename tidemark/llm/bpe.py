"""BPE encoding and decoding: a priority queue of merge ranks over a doubly linked symbol list.

The tokenizer file is one of the ``tokenizers`` library's JSON files whose model is BPE with word ends,
whose normalizer is NFC, white space to one space, lower case, and whose pre-tokenizer splits by a
pattern and then maps bytes to characters. Its place is a parameter and must be readable on every executor.

Defined results: a NULL or empty text has no tokens and decodes to the empty text. Rows with a NULL
doc_id and repeated rows are encoded like any other, row by row. Other columns are ignored. A text of
any length is encoded whole; what is cached is bounded by ``CACHED_WORDS`` words of at most
``CACHED_CHARS`` characters.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, picked

# Pieces remembered in a Python worker (under 80 MB), and the longest that is remembered.
CACHED_WORDS = 250_000
CACHED_CHARS = 64
# Signs that end a piece of letters whatever the pattern's contractions are.
SIGNS = frozenset(".,;:!?|)")

# Characters with the Unicode property White_Space; str.split() also takes U+001C to U+001F for white space.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = regex.compile(rf"[^{WHITE_SPACE}]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"

# Letters, digits and lower case that Unicode 16 and 17 added, and that the tokenizers
# library knows while Python's tables (15.1) do not.
NEW_LETTERS = r"""
    \u1c89-\u1c8a \ua7cb-\ua7cd \ua7da-\ua7dc \U000105c0-\U000105f3 \U00010d4a-\U00010d65
    \U00010d6f-\U00010d85 \U00010ec2-\U00010ec4 \U00011380-\U00011389 \U0001138b \U0001138e
    \U00011390-\U000113b5 \U000113b7 \U000113d1 \U000113d3 \U00011bc0-\U00011be0 \U00013460-\U000143fa
    \U00016100-\U0001611d \U00016d40-\U00016d6c \U00018cff \U0001e5d0-\U0001e5ed \U0001e5f0
"""
NEW_DIGITS = r"""
    \U00010d40-\U00010d49 \U000116d0-\U000116e3 \U00011bf0-\U00011bf9 \U00016130-\U00016139
    \U00016d70-\U00016d79 \U0001ccf0-\U0001ccf9 \U0001e5f1-\U0001e5fa
"""
NEW_LOWER = {
    0x1C89: 0x1C8A,
    0xA7CB: 0x0264,
    0xA7CC: 0xA7CD,
    0xA7CE: 0xA7CF,
    0xA7D2: 0xA7D3,
    0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB,
    0xA7DC: 0x019B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
_NEW_CAPITALS = regex.compile("[" + "".join(map(chr, NEW_LOWER)) + "]")

_loaded: dict[str, "Bpe"] = {}


def category_class(kind: str, more: str) -> str:
    """The inside of a character class of all characters whose category starts with ``kind``."""
    ranges: list[list[int]] = []
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == kind:
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "".join(more.split())


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Words(dict):
    """Token ids of a chunk without white space. Chunks that are one piece are remembered.

    Of ``CACHED_WORDS`` the newer half is here and the older half in ``older``. When the newer half is full, it
    becomes the older one: words that recur are taken over, words of one text are forgotten.
    """

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        # most chunks are letters, or letters and one sign after them: these need no pattern
        if chunk.isalpha():
            return self.piece(chunk)
        if (head := chunk[:-1]).isalpha() and chunk[-1] in SIGNS:
            return self[head] + (self.get(chunk[-1]) or self.piece(chunk[-1]))
        pattern = self.bpe.ascii_pieces if chunk.isascii() else self.bpe.pieces
        pieces = pattern.findall(chunk)
        return tuple(chain.from_iterable(self.get(x) or self.piece(x) for x in pieces))

    def piece(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = tuple(self.bpe.piece_ids(piece))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_WORDS // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: token for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: token for token, i in self.special.items()})
        characters = byte_characters()
        self.inner = [vocab.get(c) for c in characters]
        self.last = [vocab.get(c + suffix) for c in characters]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = [vocab[a + b] for a, b in pairs]
        # rank of a pair, by its left and then its right symbol
        self.ranks: dict[int, dict[int, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            self.ranks.setdefault(vocab[left], {})[vocab[right]] = rank
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        pattern = splits[0]["pattern"]["Regex"].replace(r"\s", WHITE_SPACE)
        ascii_pattern = pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
        self.ascii_pieces = re.compile(ascii_pattern)
        # the regex module's own classes hold drafts of characters that no Unicode version has yet
        pattern = pattern.replace(r"\p{L}", category_class("L", NEW_LETTERS))
        pattern = pattern.replace(r"\p{N}", category_class("N", NEW_DIGITS))
        self.pieces = regex.compile(pattern)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self.words = Words(self)

    @classmethod
    def at(cls, path: str) -> Bpe:
        """Loaded once in a Python worker."""
        if path not in _loaded:
            _loaded[path] = cls(path)
        return _loaded[path]

    def merged(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges, the lowest rank first and, at equal rank, the leftmost first."""
        size = len(symbols)
        after = [*range(1, size), -1]
        before = [*range(-1, size - 1)]
        ranks, made, none = self.ranks, self.made, {}
        # rank and place of the left symbol in one number, which sorts as the two do
        queue = []
        for i in range(size - 1):
            rank = ranks.get(symbols[i], none).get(symbols[i + 1])
            if rank is not None:
                queue.append(rank << 32 | i)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            rank, left = entry >> 32, entry & 0xFFFFFFFF
            right = after[left]
            # stale: the left symbol is gone, or the pair that stands here is another one by now
            if right < 0 or symbols[left] < 0:
                continue
            if ranks.get(symbols[left], none).get(symbols[right]) != rank:
                continue
            symbols[left] = new = made[rank]
            symbols[right] = -1
            beyond = after[left] = after[right]
            if beyond >= 0:
                before[beyond] = left
                rank = ranks.get(new, none).get(symbols[beyond])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | left)
            ahead = before[left]
            if ahead >= 0:
                rank = ranks.get(symbols[ahead], none).get(new)
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | ahead)
        return [s for s in symbols if s >= 0]

    def piece_ids(self, piece: str) -> list[int]:
        data = piece.encode()
        symbols = [*map(self.inner.__getitem__, data[:-1]), self.last[data[-1]]]
        return self.merged([s for s in symbols if s is not None])

    def plain_ids(self, text: str) -> Iterator[int]:
        """Ids of text without special tokens."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # str.lower() alone would turn a capital sigma at the end of a word into the final form
        text = text.replace("Σ", "σ").lower()
        if not text.isascii() and _NEW_CAPITALS.search(text):
            text = text.translate(NEW_LOWER)
        chunks = _CHUNK.findall(text) if any(map(text.__contains__, _SEPARATORS)) else text.split()
        return chain.from_iterable(map(self.words.__getitem__, chunks))

    def encode(self, text: str | None) -> list[int]:
        text = text or ""
        ids: list[int] = []
        at = 0
        for found in self.specials.finditer(text):
            ids.extend(self.plain_ids(text[at : found.start()]))
            ids.append(self.special[found[0]])
            at = found.end()
        ids.extend(self.plain_ids(text[at:]))
        return ids

    def decode(self, ids: list[int] | None) -> str:
        """Vocabulary strings with a space between, as the library does where a file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids or ()))


def encode(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row."""

    def start():
        bpe = Bpe.at(path)
        return lambda value: (bpe.encode(value),)

    return map_rows(picked(df, doc_id=doc_id, text=text), start, "ids array<int>")


def decode(df: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded) of every row with token ids."""

    def start():
        bpe = Bpe.at(path)
        return lambda value: (bpe.decode(value),)

    return map_rows(picked(df, doc_id=doc_id, ids=ids), start, "decoded string")


def encode_decode(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) in one pass over the rows."""

    def start():
        bpe = Bpe.at(path)

        def of_row(value):
            ids = bpe.encode(value)
            return ids, bpe.decode(ids)

        return of_row

    return map_rows(picked(df, doc_id=doc_id, text=text), start, "ids array<int>, decoded string")


def listed(ids: str) -> Column:
    """The column of ids as text, with one space between.

    The numbers are printed as JSON, into one buffer. Joining an array takes an array of strings, which is
    some objects for every token.
    """
    return F.replace(F.btrim(F.to_json(ids), F.lit("[]")), F.lit(","), F.lit(" "))
