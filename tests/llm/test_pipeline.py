from __future__ import annotations

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tidepanel.llm import decontam, neardup, pii

from .test_neardup import plain
from .test_pii import plain as plain_spans


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """What goes into each stage, and what comes out of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_dir).cache())
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_columns_and_rows(steps):
    for before, after in zip(steps[:-2], steps[1:-1]):
        assert after.columns == before.columns
        assert set(texts(after)) <= set(texts(before))


def test_toxic_documents_go_and_clean_ones_stay(spark):
    """On sf0.01, whose 51 toxic labels are enough to learn from; sf0.001 has eleven, of which ten may be learnt."""
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.toxic(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir).collect()}
    assert sum(i not in kept for i in labels if not labels[i]) <= 0.01 * len(labels)
    assert sum(i not in kept for i in labels if labels[i]) >= 0.5 * sum(labels.values())


def test_one_document_of_each_group_stays(steps):
    before = texts(steps[1])
    assert set(texts(steps[2])) == {i for i, (_, c) in plain(before, 5).items() if i == c}


def test_no_benchmark_passage_stays(spark, sf_dir, steps):
    from .test_decontam import leaks

    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    before = texts(steps[2])
    assert set(texts(steps[3])) == {i for i, t in before.items() if not leaks(t, items)}


def test_personal_data_is_masked(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    assert all(not plain_spans(t) for t in after.values())
    assert all(after[i] == t for i, t in before.items() if not any(c.isdigit() or c == "@" for c in t or ""))


def test_run_packs_what_is_left(spark, sf_dir, steps):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in rows.collect()} == set(texts(steps[4]))
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


ODD = [
    (1, None, "en", "a", 0, 5, "x"), (1, None, "en", "a", 0, 5, "x"), (None, "x y z q w", None, None, None, None, None), (None, "x y z q w", None, None, None, 1, "y"), (2, "", "en", "a", 0, 1, ""),
    (3, "a b c d e f", "en", "a", 1, 1, "z"), (3, "a b c d e f", "en", "a", 1, 1, "z"), (4, "A b c d e f", "en", "b", 1, None, "q"), (5, "long words " * 60_000 + "me@site.example.com", "en", "b", 1, 2, "q"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, _row string"


def test_odd_documents_pass_all_stages(spark, sf_dir):
    """Nulls, empty and long texts, repeated rows and clashing names; then the same table without rows."""
    docs = spark.createDataFrame(ODD, SCHEMA)
    size = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = out.cache()
        size.append(docs.count())
    assert size == [9, 5, 5, 5]
    texts_ = {(r.doc_id, (r.text or "")[-7:]) for r in docs.collect()}
    assert texts_ == {(1, ""), (None, "y z q w"), (2, ""), (3, "c d e f"), (5, "[email]")}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.where("doc_id = 5").count() == -(-packed.where("doc_id = 5").agg(F.sum("length")).first()[0] // 2048) > 50
    assert packed.where("doc_id is null").count() == 1
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_deduplication_of_odd_rows(spark):
    left = neardup.deduplicated(spark.createDataFrame(ODD, SCHEMA))
    assert sorted((r.doc_id or 0, (r.text or "")[:9]) for r in left.collect()) == [(0, "x y z q w"), (1, ""), (2, ""), (3, "a b c d e"), (5, "long word")]
