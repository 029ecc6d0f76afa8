"""Line dedup by a tree of line templates, in DataFrame functions only.

A line is split into tokens and every token with a digit becomes ``<*>``. The tree has a fixed depth: the
number of tokens, then the leading ``LEADING`` tokens; lines that agree in these share a leaf. Within a
leaf a word is constant at its place if at least ``CONSTANT_SHARE`` of the leaf's lines have it there, and
``MIN_DOCUMENTS`` of them; all else, ``<*>`` always, is a variable field. Being a share, the verdict on a field does not
change with the size of the table. A line's template is its constant words with their places. It counts as a
template if at least ``MIN_SIMILARITY`` of the line, and as much of what follows the leading tokens, is
constant; so lines of numbers have none. A template found in ``MIN_DOCUMENTS`` documents or more recurs, and so
does a line that stands there word by word: a line of ``LONG_TOKENS`` tokens or more recurs from two documents
on, a shorter one from ``MIN_DOCUMENTS``. Recurring lines are dropped from every document but the first
(smallest doc_id), which keeps them.

The first pass moves hashes only and finds the leaves that lie in enough documents. Lines of other leaves
cannot recur and are never moved. Such leaves, and in the end the decisions, are broadcast while they have
at most ``BROADCAST_ROWS`` rows, counted first; beyond that they take an ordinary shuffled join.

Defined results: a NULL text stays NULL and has no lines. Lines without tokens are kept. Rows equal in
doc_id and text are one document and get the same answer each; a NULL doc_id comes after all others.
Other columns are ignored by ``deduplicated`` and kept by ``apply``. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import picked, staged, text_key

LEADING = 3
MIN_DOCUMENTS = 3
MIN_SIMILARITY = 0.5
CONSTANT_SHARE = 0.05
# Lines of so many tokens do not come about twice by chance.
LONG_TOKENS = 10
# 16 to 50 MB as rows of two or three longs.
BROADCAST_ROWS = 1_000_000
FIELD = "<*>"


def single_spaced(line: Column) -> Column:
    """Single spaces between tokens. Most lines are so already."""
    odd = (
        line.rlike(r"[\t\x0B\f\r]")
        | F.contains(line, F.lit("  "))
        | F.startswith(line, F.lit(" "))
        | F.endswith(line, F.lit(" "))
    )
    return F.when(odd, F.trim(F.regexp_replace(line, r"[ \t\x0B\f\r]+", " "))).otherwise(line)


def masked(plain: Column) -> Column:
    """Tokens with a digit replaced."""
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(plain)


def _lines(rows: DataFrame) -> DataFrame:
    """(doc_id, key, at, leaf, tokens, plain, line) of every line with a token."""
    split = rows.select("doc_id", text_key().alias("key"), F.split("text", "\n").alias("lines"))
    # the outer form only spares a filter that would split the text once more
    each = split.select("doc_id", "key", F.posexplode_outer("lines").alias("at", "raw"))
    each = each.where(F.col("raw").rlike(r"[^ \t\x0B\f\r]"))
    each = each.select("doc_id", "key", "at", single_spaced(F.col("raw")).alias("plain"))
    each = each.withColumn("line", masked(F.col("plain")))
    tokens = F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1
    each = each.withColumn("tokens", tokens)
    leaf = F.xxhash64("tokens", F.substring_index("line", " ", LEADING))
    return each.withColumn("leaf", leaf)


def _document() -> Column:
    return F.xxhash64("doc_id", "key")


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted rows are within the bound. ``df`` must be a stored table."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _templates(lines: DataFrame, min_documents: int, min_similarity: float) -> DataFrame:
    """(of_leaf, of_hash, template) of each different line that has a template."""
    different = lines.groupBy("leaf", "hash").agg(F.count("*").alias("n"), F.first("line").alias("line"))
    tokens = different.select(
        "leaf", "hash", "n", F.posexplode(F.split("line", " ")).alias("place", "word")
    ).select(
        "leaf", "hash", "n", "place", F.when(F.col("word") != FIELD, F.xxhash64("word", "place")).alias("token")
    )
    support = tokens.where("token IS NOT NULL").groupBy("leaf", "token").agg(F.sum("n").alias("support"))
    totals = different.groupBy("leaf").agg(F.sum("n").alias("lines"))
    enough = F.greatest(F.lit(min_documents), F.col("lines") * CONSTANT_SHARE)
    constant = support.where(F.col("support") >= min_documents).join(totals, "leaf")
    constant = constant.where(F.col("support") >= enough).select(
        F.col("leaf").alias("of_leaf"), F.col("token").alias("constant")
    )
    found = tokens.join(
        constant, (F.col("leaf") == F.col("of_leaf")) & (F.col("token") == F.col("constant")), "left"
    )
    beyond = F.col("place") >= LEADING
    fixed = F.col("constant").isNotNull()
    shapes = found.groupBy("leaf", "hash").agg(
        F.bit_xor("constant").alias("template"),
        F.count("*").alias("size"),
        F.count_if(fixed).alias("fixed"),
        F.count_if(beyond).alias("beyond"),
        F.count_if(beyond & fixed).alias("fixed_beyond"),
    )
    like = (F.col("fixed") >= F.col("size") * min_similarity) & (
        F.col("fixed_beyond") >= F.col("beyond") * min_similarity
    )
    return shapes.where(like & (F.col("fixed") > 0)).select(
        F.col("leaf").alias("of_leaf"), F.col("hash").alias("of_hash"), "template"
    )


def _identities(candidates: DataFrame, min_documents: int, min_similarity: float) -> DataFrame:
    """(doc_id, key, at, leaf, same, least): what a line may recur as, and in how many documents at least.

    ``same`` is the line's template or its own text. A short line's text need not be looked at beside its template,
    as it cannot recur in more documents than that.
    """
    kept = candidates.select("doc_id", "key", "at", "leaf", "hash", "raw", "tokens")
    templates = _templates(candidates.where("wide"), min_documents, min_similarity)
    same = (F.col("leaf") == F.col("of_leaf")) & (F.col("hash") == F.col("of_hash"))
    shaped = kept.join(templates, same, "left")
    long_one = F.col("tokens") >= LONG_TOKENS
    as_template = F.when(
        F.col("template").isNotNull(),
        F.struct(F.xxhash64(F.lit("template"), "template").alias("same"), F.lit(min_documents).alias("least")),
    )
    as_text = F.when(
        F.col("template").isNull() | long_one,
        F.struct(
            F.xxhash64(F.lit("text"), "raw").alias("same"),
            F.when(long_one, F.least(F.lit(2), F.lit(min_documents))).otherwise(F.lit(min_documents)).alias("least"),
        ),
    )
    either = F.explode(F.filter(F.array(as_template, as_text), lambda x: x.isNotNull())).alias("is")
    return shaped.select("doc_id", "key", "at", "leaf", either).select("doc_id", "key", "at", "leaf", "is.*")


def dropped_lines(
    rows: DataFrame, min_documents: int = MIN_DOCUMENTS, min_similarity: float = MIN_SIMILARITY
) -> DataFrame:
    """(doc_id, key, dropped): positions of the lines to drop, for documents (doc_id, text) that lose any."""
    lines = _lines(rows)
    leaves = lines.groupBy("leaf").agg(F.countDistinct(_document()).alias("documents"))
    leaves = leaves.where(F.col("documents") >= min(2, min_documents))
    leaves = staged(leaves.select("leaf", (F.col("documents") >= min_documents).alias("wide")), "leaves")
    # in a leaf of two documents only long lines can recur
    candidates = lines.join(_small(leaves), "leaf").where(F.col("wide") | (F.col("tokens") >= LONG_TOKENS))
    candidates = candidates.select(
        "doc_id",
        "key",
        "at",
        "leaf",
        "wide",
        "tokens",
        F.xxhash64("plain").alias("raw"),
        F.xxhash64("line").alias("hash"),
        F.when(F.col("wide"), F.col("line")).alias("line"),
    )
    candidates = staged(candidates, "candidate-lines")
    shaped = staged(_identities(candidates, min_documents, min_similarity), "shaped-lines")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    recurring = shaped.groupBy("leaf", "same").agg(
        F.countDistinct(_document()).alias("documents"), F.min(order).alias("first"), F.first("least").alias("least")
    )
    recurring = recurring.where(F.col("documents") >= F.col("least")).select(
        F.col("leaf").alias("of_leaf"), F.col("same").alias("of_same"), "first"
    )
    hit = shaped.join(recurring, (F.col("leaf") == F.col("of_leaf")) & (F.col("same") == F.col("of_same")))
    keeps = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    gone = hit.where(~keeps).groupBy("doc_id", "key").agg(F.collect_set("at").alias("dropped"))
    return staged(gone, "dropped-lines")


def apply(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_similarity: float = MIN_SIMILARITY,
    n_lines: str | None = None,
    n_dropped: str | None = None,
) -> DataFrame:
    """The rows of ``df`` with the dropped lines taken out of the text, and counts if they are named."""
    rows = picked(df, doc_id=doc_id, text=text)
    gone = dropped_lines(rows, min_documents, min_similarity)
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = {c: f"c{i}" for i, c in enumerate(df.columns)}
    told = _small(gone.select(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"), "dropped"))
    same = F.col(at[doc_id]).eqNullSafe(F.col("of_id")) & (F.xxhash64(at[text]) == F.col("of_key"))
    joined = numbered.join(told, same, "left")
    lines = F.split(F.col(at[text]), "\n")
    left = F.filter(lines, lambda _, i: ~F.array_contains("dropped", i))
    kept = F.when(F.col("dropped").isNull(), F.col(at[text])).otherwise(F.array_join(left, "\n"))
    columns = [kept.alias(c) if c == text else F.col(at[c]).alias(c) for c in df.columns]
    if n_lines:
        columns.append(F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(n_lines))
    if n_dropped:
        columns.append(F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias(n_dropped))
    return joined.select(*columns)


def deduplicated(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row."""
    return apply(
        picked(df, doc_id=doc_id, text=text), n_lines="n_lines", n_dropped="n_dropped", **settings
    )
