"""Rows that every operator must survive, in the columns of documents and some with clashing names."""

DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, fingerprint string, bits long, ids string, shard long, n_words long, kept string, "
    "line_hash long, host string, domain int, rate double, n int, `a.b` string"
)

_EXTRA = (0.5, "f", 1, "i", 2, 3, "k", 4, "h", 5, 0.1, 6, "dot")


def row(doc_id, text, lang="en", source="src0", extra=_EXTRA):
    return (doc_id, text, lang, source, len(text) if text is not None else None, *extra)


PROSE = "One line of plain words stands here.\nAnother line follows it, and then it ends.\nThe end of it."
LONG = "word and another thing that goes on " * 20_000
UNICODE = "Straße ΑΣ ΣΑΣ İstanbul ́x é ​ \x85 \x1c   日本語 🙂 <|endoftext|> it's 12 we'll"

EDGE_ROWS = [
    row(1, PROSE),
    row(1, PROSE),
    row(2, PROSE),
    row(3, ""),
    row(4, None),
    row(5, " \n\t \n"),
    row(6, LONG),
    row(7, "x" * 200_000),
    row(8, UNICODE),
    row(9, "one"),
    row(10, PROSE.upper(), None, None, (None,) * 13),
    row(None, PROSE),
    row(None, None, None, None, (None,) * 13),
]
