from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F
from tidepanel.llm import queries, rollup, tokens


def test_whole_table(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    own, other = Tokenizer.from_file(tokens.default_path()), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = other.encode_special_tokens = True
    want = Counter()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n = len(own.encode(r.text or "", add_special_tokens=False).ids)
        m = len(other.encode(r.text or "", add_special_tokens=False).ids)
        for version, count in (("word_bpe_49k", n), ("byte_bpe_50k", m)):
            for k, v in (("docs", 1), ("tokens", count), ("chars", len(r.text or ""))):
                want[r.source, r.lang, version, k] += v * (n > 16)
    rows = queries.op6_token_rollups(spark, sf_dir).collect()
    got = {(r.source, r.lang, r.version, k): r[f"n_{k}"] for r in rows for k in ("docs", "tokens", "chars")}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def counts(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, n_tokens long, n_chars long, new_tokens long")


def test_batches_are_committed_once(spark, tmp_path):
    own = rollup.Rollup(spark, f"file://{tmp_path}/totals")
    rows = counts(spark, [("a", "en", 10, 50, 12), ("a", "en", 5, 20, None), (None, None, None, 3, 4)])
    assert own.totals(["x"]).count() == 0
    assert own.commit("x", rollup.inserts(rows, "1")) and not own.commit("x", rollup.inserts(rows, "1"))
    assert own.commit("y", rollup.revisions(rows, "1")) and own.commit("z", rollup.deletes(rows.where("n_tokens = 10"), "1"))
    rollup.summed(rollup.inserts(rows, "2")).write.parquet(f"file://{tmp_path}/totals/sums/batch=half")  # a batch that failed before its marker
    (tmp_path / "totals" / "committed" / "batch=half").mkdir()
    assert not own.committed("half")
    got = {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens, r.n_chars) for r in own.totals(["x", "y", "z", "y", "half"]).collect()}
    assert got == {("a", "en", "1"): (1, 2, 20), (None, None, "1"): (1, 4, 3)}
    assert own.commit("half", rollup.inserts(rows, "2")) and own.committed("half")


def test_null_texts(spark):
    docs = spark.createDataFrame([(1, None, "a", None), (1, "", "a", None)], "doc_id long, text string, source string, lang string")
    assert [(r.n_tokens, r.n_chars) for r in rollup.counted(docs).collect()] == [(0, 0), (0, 0)]
    assert rollup.counted(docs.limit(0)).count() == 0


def test_odd_tables(spark, tmp_path):
    long = "word, " * 100_000
    docs = spark.createDataFrame([(1, long, "a", "en", 9), (1, long, "a", "en", 9), (None, "x", None, None, 1)], "doc_id long, text string, source string, lang string, n_tokens long")
    rows = rollup.counted(docs.withColumn("id", F.lit("z")), also={"n": lambda texts: [len(t.split()) for t in texts]})
    assert sorted((r.doc_id or 0, r.n_tokens, r.n) for r in rows.collect()) == [(0, 1, 1), (1, 200_000, 100_000), (1, 200_000, 100_000)]
    own = rollup.Rollup(spark, f"file://{tmp_path}/more")
    assert own.commit("none", rollup.inserts(rows.limit(0), "1")) and own.totals(["none"]).count() == 0
    assert own.commit("all", rollup.inserts(rows.repartition(7), "1"))
    assert {(r.source, r.n_docs, r.n_tokens) for r in own.totals(["all", "none"]).collect()} == {("a", 2, 400_000), (None, 1, 1)}
