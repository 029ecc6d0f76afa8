"""Document fingerprints by a homomorphic multiset hash over paragraphs.

Every paragraph (a line between "\\n") is hashed to a wide vector, and a text's fingerprint is the sum of
its paragraphs' vectors, each lane modulo a power of two. So the order of paragraphs does not matter,
and a paragraph is put in or taken out by adding or subtracting its vector alone (``inserted``,
``deleted``), without the rest of the text.

A vector has two parts. ``EXACT`` lanes modulo 2^64 hold a cryptographic hash of the paragraph; they
decide equality. ``NEAR`` lanes modulo 2^32 hold the sum of one sign per lane for each clause of the
paragraph; their products estimate how many clauses two texts share, whatever else they hold.
``likeness`` is the cosine of these lanes, 0 where they point apart and 1 where the exact lanes agree; for
unrelated texts it stays around 0 with a deviation of 1 / sqrt(NEAR). It is right for texts of up to 2^31 clauses,
which is more than a string of Spark's can hold.

Defined results: NULL and empty texts have no paragraphs, a fingerprint of zeros, and likeness 1 to each
other. An empty line is a paragraph. Rows are ordered by doc_id, then by a hash of the text; a NULL
doc_id comes last. Repeated rows follow one another and get a row each. A table of one row has itself as
its next document. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import ROWS_AT_ONCE, map_batches, map_rows, picked, staged, text_key

EXACT = 8
NEAR = 128
CLAUSE = re.compile(r"[^.,;:!?|]{1,80}")
# Clauses whose signs are held at a time.
CLAUSES_AT_ONCE = 1 << 15

RESULT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class Fingerprint:
    """Lanes of a multiset of paragraphs."""

    def __init__(self, exact: np.ndarray | None = None, near: np.ndarray | None = None):
        self.exact = np.zeros(EXACT, np.uint64) if exact is None else exact
        self.near = np.zeros(NEAR, np.uint32) if near is None else near

    @classmethod
    def of(cls, text: str | None) -> Fingerprint:
        return cls.of_paragraphs(text.split("\n") if text else [])

    @classmethod
    def of_paragraphs(cls, paragraphs: Iterable[str]) -> Fingerprint:
        paragraphs = list(paragraphs)
        made = cls()
        hashes = b"".join(hashlib.blake2b(p.encode(), digest_size=8 * EXACT).digest() for p in paragraphs)
        made.exact = np.frombuffer(hashes, "<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
        clauses = [c for p in paragraphs for c in CLAUSE.findall(p)]
        sums = np.zeros(NEAR, np.int64)
        for at in range(0, len(clauses), CLAUSES_AT_ONCE):
            some = clauses[at : at + CLAUSES_AT_ONCE]
            digests = b"".join(xxhash.xxh3_128_digest(c.encode()) for c in some)
            bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, NEAR // 8), axis=1)
            sums += 2 * bits.sum(axis=0, dtype=np.int64) - len(some)
        made.near = sums.astype(np.uint32)
        return made

    @classmethod
    def from_hex(cls, text: str) -> Fingerprint:
        data = bytes.fromhex(text)
        return cls(
            np.frombuffer(data[: 8 * EXACT], "<u8").astype(np.uint64),
            np.frombuffer(data[8 * EXACT :], "<u4").astype(np.uint32),
        )

    def hex(self) -> str:
        return (self.exact.astype("<u8").tobytes() + self.near.astype("<u4").tobytes()).hex()

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.near + other.near)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.near - other.near)

    def likeness(self, other: Fingerprint) -> float:
        if np.array_equal(self.exact, other.exact):
            return 1.0
        a, b = (x.near.astype(np.uint32).view(np.int32).astype(np.float64) for x in (self, other))
        size = np.sqrt((a @ a) * (b @ b))
        return float(min(1.0, max(0.0, a @ b / size))) if size else 0.0


def inserted(fingerprint: str, *paragraphs: str) -> str:
    """The fingerprint after the paragraphs were put in, anywhere in the text."""
    return (Fingerprint.from_hex(fingerprint) + Fingerprint.of_paragraphs(paragraphs)).hex()


def deleted(fingerprint: str, *paragraphs: str) -> str:
    """The fingerprint after the paragraphs were taken out."""
    return (Fingerprint.from_hex(fingerprint) - Fingerprint.of_paragraphs(paragraphs)).hex()


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    return map_rows(
        picked(df, doc_id=doc_id, text=text),
        lambda: lambda value: (Fingerprint.of(value).hex(),),
        "fingerprint string",
    )


def edited_text(text: str, following: str) -> str:
    """The second half replaced by as much of the following text's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(text: str, mark: Fingerprint, following: str, next_mark: Fingerprint) -> tuple:
    edited = edited_text(text, following)
    edited_mark = Fingerprint.of(edited)
    return (
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        mark.hex(),
        edited_mark.hex(),
        mark.likeness(edited_mark),
        mark.likeness(next_mark),
    )


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint beside that of its edited text and of the next document.

    One shuffle sorts the texts by range. A task compares each row with the one that follows it and
    hands on its first and its last row under its range's number. A last row meets the first row of the next range
    that has any, and that of the last range the first of all, in a join by these numbers, so no task gets more
    than its own texts.
    """
    rows = picked(df, doc_id=doc_id, text=text).withColumn("key", text_key())
    order = [F.asc_nulls_last("doc_id"), F.asc("key")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.withColumn("range", F.spark_partition_id())
    id_field = rows.schema["doc_id"]
    made = df.sparkSession.createDataFrame([], f"{RESULT}, edge boolean, {EDGE}").schema
    done = staged(map_batches(ordered, _walk, StructType([id_field, *made.fields])), "fingerprints")
    inside = done.where("not edge").select("doc_id", *_names())
    around = done.where("edge")
    # one number for each range, of which there are as many as shuffle partitions
    ranges = sorted(r[0] for r in around.select("range").collect())
    following = list(zip(ranges, ranges[1:] + ranges[:1]))
    after = df.sparkSession.createDataFrame(following, "range int, next int")
    first = around.select(F.col("range").alias("next"), F.col("first_text").alias("following"))
    met = around.join(after, "range").join(first, "next").select("doc_id", F.col("last_text").alias("text"), "following")

    def start():
        def of_row(value, following):
            value, following = value or "", following or ""
            return compared(value, Fingerprint.of(value), following, Fingerprint.of(following))

        return of_row

    return inside.unionByName(map_rows(met, start, RESULT))


def _names() -> list[str]:
    return [field.split()[0] for field in RESULT.split(", ")]


EDGE = "range int, first_text string, last_text string"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one task in order: a result for all but the last, and one edge row."""
    first = held = mark = number = id_type = None
    names = ["doc_id", *_names(), "edge", *[field.split()[0] for field in EDGE.split(", ")]]
    types = [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.bool_(), pa.int32(), pa.string(), pa.string()]

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        columns = zip(*made)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [id_type, *types])], names)

    for batch in batches:
        id_type = batch.schema.field("doc_id").type
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            made = []
            for doc_id, text in zip(*[part.column(c).to_pylist() for c in ("doc_id", "text")]):
                text = text or ""
                now = Fingerprint.of(text)
                if held is None:
                    first, number = text, part.column("range")[0].as_py()
                else:
                    row = compared(held[1], mark, text, now)
                    made.append((held[0], *row, False, None, None, None))
                held, mark = (doc_id, text), now
            if made:
                yield batch_of(made)
    if held is not None:
        yield batch_of([(held[0], *[None] * 6, True, number, first, held[1])])
