"""Which filters remove what, in every order: a byte transducer measures the texts, a table of masks is priced.

One pass of a finite-state transducer over a text's UTF-8 bytes counts words, capitals, code points and symbols.
A byte's class and the state before it (inside or outside a word) give what is emitted; the state after it
follows from its class alone, so numpy looks the tables up for many bytes at a time, and the state is carried
from one stretch of a long text to the next. Each word's span goes into a hash table that compares bytes where
hashes agree, which counts different words exactly.

A document's failures are five bits. Four follow from its text; the fifth, that a smaller doc_id has the same
text, is not joined back to documents: per text (a SHA-256 digest) and kind of document, rows are counted before
and after the shuffle, and those of the smallest doc_id alone do not fail. A group of copies, however large,
so is a few rows from the first shuffle on. What is left is a table of masks by part, and each of the 120
orders reads its counts off that.

Defined results: a NULL text is empty, a NULL part is the empty one. Rows of the smallest doc_id with a text do
not fail E, also where there are several; a NULL doc_id is greater than all others and has no label. A doc_id
with several label rows has each label that any of them gives. Other columns are ignored, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, picked, staged

# Bytes looked at together.
STRETCH = 1 << 20

OUTSIDE, INSIDE = 0, 1
SPACE, CAPITAL, SYMBOL, CONTINUATION, OTHER = range(5)
# Bits of what is emitted.
OPENS, CLOSES, IS_CAPITAL, IS_SYMBOL, IS_POINT = 1, 2, 4, 8, 16


def _classes() -> np.ndarray:
    of = np.full(256, OTHER, np.uint8)
    of[list(b" \t\n\x0b\x0c\r")] = SPACE
    of[ord("A") : ord("Z") + 1] = CAPITAL
    of[list(b"#$%&*|")] = SYMBOL
    of[0x80:0xC0] = CONTINUATION
    return of


CLASS_OF = _classes()
# State after a byte of each class, from either state.
NEXT = np.array([OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)
# What a byte of each class emits outside and inside a word.
EMITS = np.array(
    [
        [IS_POINT, OPENS | IS_CAPITAL | IS_POINT, OPENS | IS_SYMBOL | IS_POINT, OPENS, OPENS | IS_POINT],
        [CLOSES | IS_POINT, IS_CAPITAL | IS_POINT, IS_SYMBOL | IS_POINT, 0, IS_POINT],
    ],
    np.uint8,
)
_FLAT = EMITS.ravel()
_TALLIED = np.arange(32)

MEASURES = "n_words long, n_different long, n_capitals long, n_points long, n_symbols long"


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """(words, different words, capitals, code points, symbols) of UTF-8 text."""
    state, opened = OUTSIDE, 0
    seen = np.zeros(32, np.int64)
    words: set[bytes] = set()
    for at in range(0, len(text), STRETCH):
        classes = CLASS_OF[np.frombuffer(text, np.uint8, min(STRETCH, len(text) - at), at)]
        after = NEXT[classes]
        before = np.empty_like(after)
        before[0], before[1:] = state, after[:-1]
        emitted = _FLAT[before * len(NEXT) + classes]
        seen += np.bincount(emitted, minlength=32)
        starts = (np.flatnonzero(emitted & OPENS) + at).tolist()
        ends = (np.flatnonzero(emitted & CLOSES) + at).tolist()
        if state == INSIDE:
            starts.insert(0, opened)
        state = int(after[-1])
        if state == INSIDE:
            opened = starts.pop()
        # a set keeps words by hash and compares their bytes where hashes are equal
        words.update([text[s:e] for s, e in zip(starts, ends)])
    if state == INSIDE:
        words.add(text[opened:])

    def tally(bit: int) -> int:
        return int(seen[(_TALLIED & bit) > 0].sum())

    return tally(OPENS), len(words), tally(IS_CAPITAL), tally(IS_POINT), tally(IS_SYMBOL)


# The filters that a text alone decides, by letter; a document fails where the condition holds.
OF_TEXT: dict[str, Callable[[], Column]] = {
    "A": lambda: F.col("n_words") < 100,
    "B": lambda: F.col("n_different") * 100 < F.col("n_words") * 80,
    "C": lambda: F.col("n_capitals") * 100 > F.col("n_points") * 10,
    "D": lambda: F.col("n_symbols") > 0,
}
COPY = "E"
FILTERS = [*OF_TEXT, COPY]
ORDERS = ["".join(order) for order in permutations(FILTERS)]
_BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}


def measured(df: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, digest, the measures, fails) of every row; ``fails`` has the bits of the text's filters."""
    rows = picked(df, doc_id=doc_id, text=text, part=part)
    body = F.coalesce("text", F.lit(""))
    asked = rows.select(
        "doc_id",
        F.coalesce("part", F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        body.cast("binary").alias("body"),
    )
    counted = map_rows(asked, lambda: measure, MEASURES, keep=("doc_id", "part", "digest"))
    bits = [F.when(condition(), _BIT[letter]).otherwise(0) for letter, condition in OF_TEXT.items()]
    return counted.withColumn("fails", sum(bits, F.lit(0)))


def _labelled(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows counted by (doc_id, text, part), with their labels."""
    alike = counted.groupBy("doc_id", "digest", "part", "fails").agg(F.count("*").alias("n"))
    given = picked(labels, of="doc_id", quality="quality", toxic="toxic").where("of IS NOT NULL")
    known = given.groupBy("of").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    # rows without an id would all meet at one key of the join
    named = alike.where("doc_id IS NOT NULL").join(known, F.col("doc_id") == F.col("of"), "left").drop("of")
    nameless = alike.where("doc_id IS NULL").withColumns({"good": F.lit(False), "toxic": F.lit(False)})
    either = named.unionByName(nameless)
    return either.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def masks(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): documents by part, labels and the set of all filters they fail."""
    kind = ["part", "fails", "good", "toxic"]
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    cells = _labelled(counted, labels).groupBy("digest", *kind).agg(
        F.sum("n").alias("n"), F.min(F.struct(place.alias("place"), "n")).alias("first")
    )
    # a text has at most as many cells as there are kinds of documents
    least = F.min("first.place").over(Window.partitionBy("digest"))
    originals = F.when(F.col("first.place") == least, F.col("first.n")).otherwise(0)
    split = cells.withColumn("originals", originals).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct("fails", F.col("originals").cast("long").alias("n")),
                F.struct((F.col("fails") + _BIT[COPY]).alias("fails"), (F.col("n") - F.col("originals")).alias("n")),
            )
        ).alias("of"),
    )
    return split.select("part", "good", "toxic", "of.*").groupBy(*kind).agg(F.sum("n").alias("n"))


def audit(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """One row for each part, order of the filters and step, with what the step's filter does there."""
    found = masks(staged(measured(df, doc_id, text, part), "measures"), labels)
    orders = F.explode(F.array(*[F.lit(order) for order in ORDERS])).alias("filter_order")
    steps = found.select("*", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = "shiftleft(1, ascii({}) - ascii('A'))"
    earlier = "aggregate(slice(split(filter_order, ''), 1, step - 1), 0, (set, x) -> set | " + bits.format("x") + ")"
    asked = steps.withColumn("own", F.expr(bits.format("substring(filter_order, step, 1)"))).withColumn(
        "earlier", F.expr(earlier)
    )
    fails = F.col("fails")
    own = fails.bitwiseAND(F.col("own")) > 0
    gone = fails.bitwiseAND(F.col("earlier")) > 0

    def counted(condition: Column, value: Column = F.col("n")) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    # among the filters that a document fails, each comes first in an equal share of the orders
    share = F.col("n") * len(ORDERS) / F.greatest(F.bit_count(fails), F.lit(1))
    return asked.groupBy("part", "filter_order", "step").agg(
        counted(~own & ~gone).alias("kept"),
        counted(own & ~gone).alias("removed"),
        counted(own & gone).alias("redundant"),
        counted(fails == F.col("own")).alias("unique_fails"),
        counted(own & ~gone & F.col("good")).alias("good_lost"),
        counted(own & ~gone & F.col("toxic")).alias("toxic_lost"),
        counted(own, F.round(share).cast("long")).alias("shapley"),
    )
