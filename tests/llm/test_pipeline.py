"""The pipeline against its stages worked out plainly, and what every stage must do."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from llm.cases import DOCUMENTS, row
from llm.test_simhash import slow_components, slow_fingerprint
from tidemark.llm import simhash


def prose(seed, words=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("aeioulrstn", k=rng.randint(3, 8))) for _ in range(words))


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    """[(name, docs in, docs out)] of every stage over the small table."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, small).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_all_but_the_last_return_the_columns(stages):
    for name, (before, after) in stages.items():
        if name != "bpe":
            assert after.columns == before.columns and after.dtypes == before.dtypes


def test_rules_reject_what_the_verdict_rejects(stages):
    from tidemark.llm import quality_rules

    before, after = stages["quality_rules"]
    kept = {r.doc_id for r in quality_rules.verdicts(before).collect() if r.kept}
    assert {r.doc_id for r in after.collect()} == kept
    assert 0 < len(kept) < before.count()


def test_line_dedup_keeps_rows(stages):
    before, after = stages["line_dedup"]
    texts = {r.doc_id: r.text for r in before.collect()}
    left = {r.doc_id: r.text for r in after.collect()}
    assert texts.keys() == left.keys()
    assert all(set(left[i].split("\n")) <= {*texts[i].split("\n"), ""} for i in texts)
    assert left != texts


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_near_dedup"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    roots = slow_components([slow_fingerprint(t) for _, t in rows])
    expected = {rows[i][0] for i in roots}
    assert sorted(r.doc_id for r in after.collect()) == sorted(expected)
    assert len(expected) < len(rows)


def test_mixture_keeps_good_documents(spark, small, stages):
    before, after = stages["source_mixing"]
    texts = {r.doc_id: r.text for r in before.collect()}
    out = after.collect()
    assert all(r.text == texts[r.doc_id] for r in out)
    good = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    assert len(good & {r.doc_id for r in out}) >= 0.95 * len(good & texts.keys())


def test_tokens_are_the_library_s(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before, after = stages["bpe"]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert after.count() == before.count()
    for r in after.collect():
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) and r.decoded == library.decode(r.ids, skip_special_tokens=False)


def test_copies_nulls_and_clashing_columns_in_near_dedup(spark, edge, nothing):
    copies = [row(i, prose(1)) for i in (5, 3, 9)] + [row(i, prose(i)) for i in (11, 12)]
    copies += [row(None, prose(2)), row(20, prose(2)), row(None, prose(30))]
    out = simhash.one_of_each(spark.createDataFrame(copies, DOCUMENTS))
    assert sorted(repr(r.doc_id) for r in out.collect()) == sorted(["3", "11", "12", "20", "None"])
    assert simhash.one_of_each(nothing).count() == 0
    assert simhash.one_of_each(edge).columns == edge.columns


def test_stages_on_edge_rows_and_empty_tables(spark, edge, nothing, small):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, small).count() == 0
        stage(spark, edge, small).count()


def test_rows_equal_in_id_and_text_leave_one(spark, edge):
    rows = [row(1, prose(1))] * 3 + [row(2, prose(2)), row(2, prose(2), "fr"), row(None, prose(3)), row(None, prose(3))]
    out = simhash.one_of_each(spark.createDataFrame(rows, DOCUMENTS).repartition(4))
    assert sorted(repr(r.doc_id) for r in out.collect()) == ["1", "2", "None"]
    assert simhash.one_of_each(edge).count() == simhash.one_of_each(edge.unionByName(edge)).count()


def test_columns_with_the_names_used_in_near_dedup(spark):
    from pyspark.sql import functions as F

    names = ["gone_id", "gone_key", "of_id", "of_key", "first", "n", "key", "c0", "kept", "none"]
    df = spark.createDataFrame([row(i, prose(i % 3))[:4] for i in range(9)], "doc_id long, text string, lang string, source string")
    clashing = df.withColumns({n: F.lit(7) for n in names})
    out = simhash.one_of_each(clashing)
    assert out.columns == clashing.columns
    assert sorted((r.doc_id, r.gone_id, r.kept) for r in out.collect()) == [(0, 7, 7), (1, 7, 7), (2, 7, 7)]
