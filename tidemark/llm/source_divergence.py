"""How far sources of a language are apart, by one-hot level products.

Terms are counted by (language, source). A smoothed share p of a term in a group depends on its count there
alone, so a pair of groups is priced from its joint table: how many terms have count a in one and b in the other.
With a 0/1 column for each (group, count level) and a row for each term, the product of that matrix's transpose
with itself holds every joint table of all pairs at once. Terms are cut into blocks by a hash, a block into
tiles of at most ``TILE_COLUMNS`` columns (terms of like counts side by side, so that few levels meet), and
each tile is one dense product. Its entries count terms of a tile, so float32 holds them exactly; prices are
64-bit integers, worked out by Python's own integers from the counts.

A language with more than about ``GROUPS`` sources is cut into hashed chunks of them, and a block is taken once
for each pair of chunks, so neither a tile nor a task grows with the number of sources. Terms that no source
of the two chunks has are not shipped: they all meet at level (0, 0) and are added by their number.

Defined results: NULL text, language and source are empty ones. A term is kept in a language where at least
``LEAST_DOCUMENTS`` of its documents have it. A group without kept terms has a count of 0 for each; a language
without kept terms gives pairs of value 0 and no term rows, and one with a single source gives no pairs. Equal
values rank by the item's UTF-8 bytes. Repeated rows count as often as they come. Other columns are
ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ROWS_AT_ONCE, map_batches, picked, ship_package, staged

LEAST_DOCUMENTS = 30
UNIT = 1_000_000_000
SMOOTHING = 5
TOP_TERMS = 50

# Sources of a chunk, cells (sources x terms) of a block, and columns of a tile: 4 MB in float32, 8 MB of each table.
GROUPS = 64
BLOCK_CELLS = 1 << 16
TILE_COLUMNS = 1024
# Different terms of groups held in a task before they are sent on.
HELD = 1 << 17

# A-Z to lower case, everything that is in no term to a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


# By group: occurrences of each term, and documents with it.
Held = dict[tuple[str, str], tuple[Counter, Counter]]


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, count, docs), added up; each group also has a row without a term."""
    rows = picked(df, lang=lang, source=source, text=text)
    empty = F.lit("")
    asked = rows.select(
        F.coalesce("lang", empty).alias("lang"),
        F.coalesce("source", empty).alias("source"),
        F.coalesce("text", empty).cast("binary").alias("text"),
    )
    names = ["lang", "source", "term", "count", "docs"]
    types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]

    def sent(held: Held) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (group, name), (counts, docs) in held.items():
            terms = [None, *counts]
            values = [group] * len(terms), [name] * len(terms), terms
            numbers = [0, *counts.values()], [0, *map(docs.__getitem__, counts)]
            for column, more in zip(columns, (*values, *numbers)):
                column.extend(more)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Held = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                for group, name, text in zip(*[part.column(i).to_pylist() for i in range(3)]):
                    counts, docs = held[group, name]
                    terms, before = terms_of(text), len(counts)
                    counts.update(terms)
                    docs.update(set(terms))
                    size += len(counts) - before
                    if size >= HELD:
                        yield sent(held)
                        held.clear()
                        size = 0
        yield sent(held)

    found = map_batches(asked, run, "lang string, source string, term binary, count long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )


def price(count: int, total: int, terms: int) -> int:
    """Share of a term in billionths, smoothed and never 0; exact for counts of any size."""
    return 1 + UNIT * (count + SMOOTHING) // (total + SMOOTHING * terms)


def _price(count: Column, total: Column, terms: Column) -> Column:
    """The same as a column; decimals, since the product passes 64 bits at ten billion occurrences."""
    above = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = F.greatest(total + SMOOTHING * terms, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


class Corpus:
    """Counts of kept terms, stored, with what is known of each language and group."""

    def __init__(self, counts: DataFrame, least_documents: int = LEAST_DOCUMENTS):
        counts = staged(counts, "term-counts")
        words = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
            F.sum("docs").alias("docs"), F.sum("count").alias("lang_count")
        )
        words = words.where(F.col("docs") >= least_documents).drop("docs")
        self.counts = staged(counts.drop("docs").join(words, ["lang", "term"]), "kept-counts")
        groups = counts.where("term IS NULL").select("lang", "source")
        totals = self.counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
        totals = groups.join(totals, ["lang", "source"], "left").fillna(0, ["total"])
        kept = words.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total"))
        sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
        langs = sources.join(kept, "lang", "left").fillna(0, ["terms", "lang_total"])
        self.groups = staged(totals.join(langs, "lang"), "groups")


def _tiles(codes: np.ndarray) -> Iterator[slice]:
    """Stretches of terms (rows of ``codes``) whose (group, level) columns are few enough for one product."""
    begin, columns = 0, set()
    for i, row in enumerate(codes):
        new = columns.union(row.tolist())
        if len(new) > TILE_COLUMNS and i > begin:
            yield slice(begin, i)
            begin, new = i, set(row.tolist())
        columns = new
    yield slice(begin, len(codes))


def _product(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the columns there are, their 0/1 matrix multiplied by its transpose): all joint tables of the terms."""
    present, place = np.unique(codes, return_inverse=True)
    hot = np.zeros((len(present), len(codes)), np.float32)
    hot[place.reshape(codes.shape), np.arange(len(codes))[:, None]] = 1
    return present, (hot @ hot.T).astype(np.int64)


def price_block(
    source: np.ndarray, term: np.ndarray, count: np.ndarray, groups: int, prices: Callable[[int, int], int]
) -> np.ndarray:
    """Sum over the block's terms of |p - q| for every pair of groups.

    ``source`` and ``term`` number the group and the term of each count; ``prices(group, count)`` is p.
    """
    terms = int(term.max()) + 1
    levels = np.zeros((terms, groups), np.int64)
    levels[term, source] = count
    # like counts side by side, so that the terms of a tile share their levels
    levels = levels[np.argsort(levels.sum(axis=1), kind="stable")]
    counts, place = np.unique(levels, return_inverse=True)
    keys = place.reshape(levels.shape) + np.arange(groups) * len(counts)
    columns, codes = np.unique(keys, return_inverse=True)
    codes = codes.reshape(levels.shape)
    group_of = columns // len(counts)
    worth = [prices(g, c) for g, c in zip(group_of.tolist(), counts[columns % len(counts)].tolist())]
    worth = np.array(worth, np.int64)
    out = np.zeros((groups, groups), np.int64)
    for tile in _tiles(codes):
        present, joint = _product(codes[tile])
        p, first = worth[present], np.unique(group_of[present], return_index=True)[1]
        weighed = joint * np.abs(p[:, None] - p[None, :])
        out += np.add.reduceat(np.add.reduceat(weighed, first, axis=0), first, axis=1)
    return out


PAIRS = "lang string, source string, item string, value long, seen long"


def _of_block(table: pa.Table) -> pa.Table:
    """Pairs of one block and two chunks of sources: what the block's terms add, and how many terms that were."""
    lang, kept, first, second = [table.column(c)[0].as_py() for c in ("lang", "terms", "first", "second")]
    told = table.filter(pc.is_null(table.column("term"))).sort_by("source").to_pydict()
    names, chunks, totals = told["source"], told["chunk"], told["total"]
    cells = table.filter(pc.is_valid(table.column("term")))
    values, seen = np.zeros((len(names), len(names)), np.int64), 0
    if cells.num_rows:
        source = pc.index_in(cells.column("source"), pa.array(names, pa.string())).to_numpy()
        words = cells.column("term").combine_chunks().dictionary_encode()
        seen = len(words.dictionary)
        count = cells.column("count").to_numpy()
        values = price_block(
            source, words.indices.to_numpy(), count, len(names), lambda g, c: price(c, totals[g], kept)
        )
    # between the two chunks, or within the one
    ends = ((first, second), (second, first))
    found = [
        (i, j)
        for i, own in enumerate(chunks)
        for j, other in enumerate(chunks)
        if i != j and (own, other) in ends
    ]
    columns = {
        "lang": pa.array([lang] * len(found), pa.string()),
        "source": pa.array([names[i] for i, _ in found], pa.string()),
        "item": pa.array([names[j] for _, j in found], pa.string()),
        "value": pa.array([int(values[at]) for at in found], pa.int64()),
        "seen": pa.array([seen] * len(found), pa.int64()),
    }
    return pa.table(columns)


def pairs(corpus: Corpus) -> DataFrame:
    """(lang, source, item, value): summed differences of every two sources of a language."""
    chunks = F.ceil(F.col("sources") / GROUPS).cast("int")
    wide = F.least(F.col("sources"), F.lit(GROUPS))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") * wide / BLOCK_CELLS)).cast("int")
    groups = corpus.groups.where("sources > 1").select(
        "lang",
        "source",
        "total",
        "terms",
        chunks.alias("chunks"),
        blocks.alias("blocks"),
        F.pmod(F.xxhash64("source"), chunks).cast("int").alias("chunk"),
    )
    of = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    counted = corpus.counts.select("lang", "source", "term", "count").join(groups, ["lang", "source"])
    counted = counted.withColumn("block", of)
    # every block is told of every group, also of those without a term in it
    told = groups.withColumns({"term": F.lit(None).cast("string"), "count": F.lit(0).cast("long")})
    told = told.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = counted.unionByName(told)
    partner = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    placed = rows.withColumn("partner", partner).withColumns(
        {"first": F.least("chunk", "partner"), "second": F.greatest("chunk", "partner")}
    )
    ship_package(rows.sparkSession)
    names = ["lang", "source", "term", "count", "total", "terms", "chunk", "block", "first", "second"]
    found = placed.select(*names).groupBy("lang", "block", "first", "second").applyInArrow(_of_block, PAIRS)
    summed = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    own = corpus.groups.select("lang", "source", "total", "terms")
    other = corpus.groups.select("lang", F.col("source").alias("item"), F.col("total").alias("other_total"))
    both = summed.join(own, ["lang", "source"]).join(other, ["lang", "item"])
    zero = F.lit(0)
    apart = F.abs(_price(zero, F.col("total"), F.col("terms")) - _price(zero, F.col("other_total"), F.col("terms")))
    rest = F.when(F.col("terms") > F.col("seen"), (F.col("terms") - F.col("seen")) * apart).otherwise(0)
    return both.select("lang", "source", "item", (F.col("value") + rest).cast("long").alias("value"))


def telling_terms(corpus: Corpus) -> DataFrame:
    """(lang, source, item, value): terms that a source has more of than its language, and by how much."""
    counted = corpus.counts.join(corpus.groups, ["lang", "source"])
    p = _price(F.col("count"), F.col("total"), F.col("terms"))
    q = _price(F.col("lang_count"), F.col("lang_total"), F.col("terms"))
    more = counted.where("count > 0").select("lang", "source", F.col("term").alias("item"), (p - q).alias("value"))
    return more.where("value > 0")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def divergence(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and each source's most telling terms."""
    corpus = Corpus(term_counts(df, text, lang, source), least_documents)
    top = _ranked(telling_terms(corpus), "term").where(F.col("rank") <= top_terms)
    return _ranked(pairs(corpus), "pair").unionByName(top)
