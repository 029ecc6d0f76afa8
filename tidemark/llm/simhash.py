"""SimHash near-duplicates, with vantage-point trees as the search for close fingerprints.

A fingerprint has 64 bits, cut into ``SEGMENTS`` equal parts. Two fingerprints within ``max_bits`` differ
by at most ``max_bits // SEGMENTS`` bits in one of the parts, so every part gets a vantage-point tree of
its own, over the Hamming distance of that part, searched at that small radius. In whole fingerprints all
distances lie near 32, and a tree at radius 4 prunes next to nothing; in a part of 16 bits at radius 1 it
does. A node splits by the median distance to its vantage point. By the triangle inequality only
fingerprints within the radius of that border can have neighbours on the other side: these are looked up
in both branches, all others in one. What a leaf puts together is compared on all 64 bits, so the links
are exact.

The top of the trees is built from ``SAMPLE`` fingerprints and deals the fingerprints out to shards; below
it each shard goes on with trees of its own. The sample only steers how even the shards are, never what is
found. A shard that got too many fingerprints is cut by hash, and its lookups go to every piece. A shard
returns a star for each group it finds, never all pairs.

Defined results: NULL, empty and wordless texts have fingerprint zero and link like any other. Fewer words
than a shingle needs: the whole sequence is the one shingle. Rows that repeat get the same answer each; a
NULL doc_id is never the smallest of a component unless all are NULL. Other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, map_rows, picked, staged, text_key
from tidemark.llm.components import smallest_reachable

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = 4

# Fingerprints a shard is meant to own, the least depth of the top trees, and the most fingerprints they
# are built from.
SHARD_SIZE = 4096
LEAST_DEPTH = 4
SAMPLE = 65_536
# Local trees stop at so many fingerprints; hashes are turned into bits, and pairs compared, so many at a time.
LEAF_SIZE = 96
HASHES_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 22

_PART_BITS = 64 // SEGMENTS
_PART_MASK = (1 << _PART_BITS) - 1


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bits set in over half the shingle hashes, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    bounds = list(zip(starts[: 1 - shingle_words].tolist(), ends[shingle_words - 1 :].tolist()))
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(bounds), HASHES_AT_ONCE):
        hashes = [digest(joined[a:b], SEED) for a, b in bounds[at : at + HASHES_AT_ONCE]]
        rows = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(bounds)).tobytes(), "big")


def fingerprints(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """(doc_id, key, bits): a hash of the text, and the fingerprint as a signed long, one row for each row of ``df``."""

    def start():
        def of_row(value):
            bits = fingerprint(value, shingle_words)
            return (bits - (1 << 64) if bits >> 63 else bits,)

        return of_row

    rows = picked(df, doc_id=doc_id, text=text).withColumn("key", text_key())
    return map_rows(rows, start, "bits long", keep=("doc_id", "key"))


def part_of(bits: np.ndarray, segment: int) -> np.ndarray:
    return (bits >> np.uint64(segment * _PART_BITS)) & np.uint64(_PART_MASK)


def split(parts: np.ndarray, seed: int) -> tuple[np.uint64, int]:
    """A vantage point for a node, and the median distance to it.

    Of a few candidates the one whose distances spread most is taken, as it has the fewest
    fingerprints near the border.
    """
    few = np.random.default_rng(seed).choice(parts, min(8, len(parts)), replace=False)
    distances = np.bitwise_count(parts[None, :] ^ few[:, None])
    best = int(np.argmax(distances.var(axis=1)))
    return few[best], int(np.median(distances[best]))


def top_tree(sample: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """(vantage point, border) of each inner node, breadth first: children of i are 2i + 1 and 2i + 2."""
    nodes: list[tuple[int, int]] = []
    level = [sample]
    for _ in range(depth):
        below = []
        for members in level:
            if not len(members):
                members = sample
            point, border = split(members, len(nodes))
            nodes.append((int(point), border))
            near = np.bitwise_count(members ^ point) <= border
            below += [members[near], members[~near]]
        level = below
    return nodes


def routes(
    parts: np.ndarray, nodes: list[tuple[int, int]], depth: int, radius: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, indexes that go there, whether they live there) through the top tree."""
    waiting = [(0, np.arange(len(parts)), np.ones(len(parts), bool))]
    while waiting:
        node, members, home = waiting.pop()
        if not len(members):
            continue
        if node >= (1 << depth) - 1:
            yield node - ((1 << depth) - 1), members, home
            continue
        point, border = nodes[node]
        distance = np.bitwise_count(parts[members] ^ np.uint64(point)).astype(np.int64)
        near = distance <= border
        to_near, to_far = distance <= border + radius, distance > border - radius
        waiting.append((2 * node + 1, members[to_near], (home & near)[to_near]))
        waiting.append((2 * node + 2, members[to_far], (home & ~near)[to_far]))


class Groups:
    """Union-find over array indexes, a block of pairs at a time."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, members: np.ndarray) -> np.ndarray:
        roots = self.parent[members]
        while not np.array_equal(above := self.parent[roots], roots):
            roots = above
        return roots

    def union(self, left: np.ndarray, right: np.ndarray) -> None:
        while True:
            a, b = self.roots(left), self.roots(right)
            apart = a != b
            if not apart.any():
                return
            left, right = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(left, right), np.minimum(left, right))


def search(
    bits: np.ndarray, home: np.ndarray, segment: int, radius: int, max_bits: int
) -> np.ndarray:
    """Root index of every fingerprint of a shard: those linked within it share a root.

    Fingerprints that live here are the tree; all that came here are looked up in it.
    """
    groups = Groups(len(bits))
    parts = part_of(bits, segment)
    waiting = [(np.flatnonzero(home), np.arange(len(bits)))]
    while waiting:
        tree, asked = waiting.pop()
        if not len(tree) or not len(asked):
            continue
        if len(tree) > LEAF_SIZE:
            point, border = split(parts[tree], len(tree))
            inner = np.bitwise_count(parts[tree] ^ point).astype(np.int64)
            if inner.min() < inner.max():
                border = min(border, int(inner.max()) - 1)
                outer = np.bitwise_count(parts[asked] ^ point).astype(np.int64)
                waiting.append((tree[inner <= border], asked[outer <= border + radius]))
                waiting.append((tree[inner > border], asked[outer > border - radius]))
                continue
        step = max(1, PAIRS_AT_ONCE // len(tree))
        for at in range(0, len(asked), step):
            some = asked[at : at + step]
            close = np.bitwise_count(bits[some][:, None] ^ bits[tree][None, :]) <= max_bits
            i, j = np.nonzero(close)
            groups.union(some[i], tree[j])
    return groups.roots(np.arange(len(bits)))


def close_groups(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``bits``: enough of them to connect all that are close."""
    spark = distinct.sparkSession
    radius = max_bits // SEGMENTS
    total = distinct.count()
    depth = max(LEAST_DEPTH, int(np.ceil(np.log2(max(1, total) / SHARD_SIZE))))
    wanted = min(SAMPLE, 64 << depth)
    chosen = distinct.orderBy(F.xxhash64("bits"), "bits").limit(wanted).collect()
    sample = np.array([r.bits for r in chosen] or [0], np.int64).view(np.uint64)
    trees = [top_tree(part_of(sample, s), depth) for s in range(SEGMENTS)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy(zero_copy_only=False).view(np.uint64)
            for segment in range(SEGMENTS):
                for leaf, members, home in routes(
                    part_of(bits, segment), trees[segment], depth, radius
                ):
                    shard = np.full(len(members), segment << depth | leaf, np.int64)
                    columns = [pa.array(shard), pa.array(bits[members].view(np.int64)), pa.array(home)]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "bits", "home"])

    dealt = staged(map_batches(distinct, deal, "shard long, bits long, home boolean"), "shards")
    # One row for each shard: their number is fixed by the depth.
    sizes = dealt.where("home").groupBy("shard").agg(F.count("*").alias("n"))
    pieces = sizes.select("shard", F.ceil(F.col("n") / (4 * SHARD_SIZE)).cast("int").alias("pieces"))
    large = {r.shard: r.pieces for r in pieces.where("pieces > 1").collect()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, bits = (batch.column(c).to_numpy() for c in ("shard", "bits"))
            home = batch.column("home").to_numpy(zero_copy_only=False)
            of = np.array([large.get(s, 1) for s in shard.tolist()], np.int64)
            row = np.repeat(np.arange(len(of)), of)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(of) - of, of)
            mixed = bits.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            here = home & (of == 1)
            own = here[row] | (home[row] & (piece == (mixed % of.astype(np.uint64)).astype(np.int64)[row]))
            columns = [pa.array(v) for v in (shard[row], piece, bits[row], own)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "piece", "bits", "home"])

    if large:
        dealt = map_batches(dealt, cut, "shard long, piece long, bits long, home boolean")
    else:
        dealt = dealt.withColumn("piece", F.lit(0).cast("long"))

    def linked(table: pa.Table) -> pa.Table:
        bits = table.column("bits").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False)
        segment = table.column("shard")[0].as_py() >> depth
        roots = search(bits, home, segment, radius, max_bits)
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        signed = bits.view(np.int64)
        return pa.table({"a": signed[moved], "b": signed[roots[moved]]})

    return dealt.groupBy("shard", "piece").applyInArrow(linked, "a long, b long").distinct()


def components(
    df: DataFrame, doc_id: str, text: str, shingle_words: int, max_bits: int
) -> DataFrame:
    """(doc_id, key, bits, first) for each row: ``first`` is the smallest (none, doc_id, key) it reaches."""
    marked = staged(fingerprints(df, doc_id, text, shingle_words), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    classes = staged(marked.groupBy("bits").agg(F.min(order).alias("smallest")), "classes")
    links = close_groups(classes.select("bits"), max_bits)
    roots = smallest_reachable(links)
    placed = classes.join(roots, classes.bits == roots.node, "left").select(
        "bits", "smallest", F.coalesce("root", "bits").alias("root")
    )
    smallest = placed.groupBy("root").agg(F.min("smallest").alias("first"))
    members = placed.join(smallest, "root").select(F.col("bits").alias("class"), "first")
    return marked.join(members, F.col("bits") == F.col("class")).drop("class")


def near_duplicates(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row: documents whose fingerprints are linked, directly
    or through others, share a component, named by its smallest doc_id."""
    return components(df, doc_id, text, shingle_words, max_bits).select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def one_of_each(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row of ``df`` for each component, with all its columns: its first document.

    First is the smallest doc_id, then the smallest hash of the text. Of rows equal in both one stays, that
    whose columns are the smallest as JSON; rows equal in everything are one row.
    """
    found = components(df, doc_id, text, shingle_words, max_bits)
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    # only those that go, and those that come more than once, need to be told
    told = found.groupBy("doc_id", "key").agg(F.count("*").alias("n"), F.max(first).alias("first"))
    told = told.where("NOT first OR n > 1")
    # numbered names inside: a caller's may be equal to new ones
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = {c: F.col(f"c{i}") for i, c in enumerate(df.columns)}
    told = told.select(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), "first")
    same = at[doc_id].eqNullSafe(F.col("of_id")) & (F.xxhash64(at[text]) == F.col("of_key"))
    joined = numbered.join(told, same, "left").where("first IS NULL OR first")
    once = joined.where("first IS NULL").select(*numbered.columns)
    again = joined.where("first").select(*numbered.columns)
    whole = F.to_json(F.struct(*numbered.columns), {"ignoreNullFields": "false"})
    keys = [at[doc_id].alias("of_id"), F.xxhash64(at[text]).alias("of_key")]
    kept = again.groupBy(*keys).agg(F.min_by(F.struct(*numbered.columns), whole).alias("kept"))
    return once.unionByName(kept.select("kept.*")).toDF(*df.columns)
