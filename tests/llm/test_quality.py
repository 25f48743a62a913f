from __future__ import annotations

from collections import Counter
from math import isfinite, log

import numpy as np
from pyspark.sql import functions as F
from tidepanel.llm import quality, queries


def test_whole_table_against_counts_by_hand(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    raw, target = Counter(), Counter()
    for i, t in docs.items():
        c = Counter(quality.slots(t).tolist())
        raw.update(c)
        if labels.get(i) == 1:
            target.update(c)
    n, m = sum(raw.values()) + quality.SLOTS, sum(target.values()) + quality.SLOTS
    ratio = {s: log((target[s] + 1) / m) - log((raw[s] + 1) / n) for s in range(quality.SLOTS)}
    rows = queries.op10_importance_resampling(spark, sf_dir).collect()
    assert len(rows) == round(sum(labels.values()) / len(labels) * len(docs))
    for r in rows:
        own = quality.slots(docs[r.doc_id])
        want = sum(ratio[s] for s in own)
        assert abs(r.log_weight - want) < 1e-6 * max(1, len(own)) and isfinite(r.key)
    kept = {r.doc_id for r in rows}
    good, bad = ([i in kept for i, y in labels.items() if y == q] for q in (1, 0))
    assert sum(good) / len(good) > sum(bad) / len(bad)


def test_top_k_with_ties(spark):
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.standard_normal(5000), np.full(700, 0.25), [1e9, -1e9]])
    rows = spark.createDataFrame([(i, float(k)) for i, k in enumerate(keys)], "doc_id long, key double").repartition(5, F.col("doc_id")).cache()
    order = sorted(range(len(keys)), key=lambda i: (-keys[i], i))
    for k in (0, 1, 17, 1900, 2200, 2500, 5701, 9999):
        assert {r.doc_id for r in quality.top_k(rows, k, enough=50).collect()} == set(order[:k])
    same = rows.withColumn("key", F.lit(1.0))
    assert {r.doc_id for r in quality.top_k(same, 5).collect()} == set(range(5))


def test_the_rows_drawn_are_those_with_the_largest_keys(spark, sf_dir):
    """The whole query against a sort of all keys, computed here from counts and from the noise of each id."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    ratio, good = quality.fit(docs, labels)
    drawn = docs.select("doc_id", "text", F.xxhash64("doc_id", F.lit(0)).alias("h")).collect()
    keys = {r.doc_id: sum(ratio[quality.slots(r.text)]) - log(-log((r.h % ((1 << 52) - 1) + 0.5) / (1 << 52))) for r in drawn}
    want = sorted(keys, key=lambda i: (-keys[i], i))[: round(good * len(keys))]
    assert {r.doc_id for r in queries.op10_importance_resampling(spark, sf_dir).collect()} == set(want)


def test_means_ignore_length(spark):
    docs = spark.createDataFrame([(1, "good word"), (2, "good word " * 50)], "doc_id long, text string")
    ratio = np.random.default_rng(1).standard_normal(quality.SLOTS)
    a, b = sorted(quality.weighted(docs, ratio, per_gram=64.0).collect())
    own = ratio[quality.slots("good word")]
    assert abs(a.log_weight - 64 * own.mean()) < 1e-9 and abs(b.log_weight) < 64 * abs(own).max() + 1e-9


def test_ties_of_one_id_and_of_none(spark, tmp_path):
    spark.createDataFrame([(7, 1.0)] * 40 + [(None, 1.0)] * 30 + [(1, 2.0), (9, 1.0)], "doc_id long, key double").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    for k, want in ((1, {1: 1}), (20, {1: 1, 7: 19}), (41, {1: 1, 7: 40}), (42, {1: 1, 7: 40, 9: 1}), (60, {1: 1, 7: 40, 9: 1, None: 18})):
        assert Counter(r.doc_id for r in quality.top_k(rows, k, enough=5).collect()) == want
    docs = spark.createDataFrame([(None, "same")] * 300, "doc_id long, text string")
    assert len({r.key for r in quality.weighted(docs, np.zeros(quality.SLOTS)).collect()}) == 300


def test_odd_input(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "word " * 30_000), (3, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (3, 1), (9, 0)], "doc_id long, quality int")
    ratio, good = quality.fit(docs, labels)
    assert good == 0.5 and all(isfinite(r.key) for r in quality.weighted(docs, ratio).collect())
    assert quality.resampled(docs, labels.limit(0)).count() == 5
    assert quality.resampled(docs.limit(0), labels).count() == 0
    clash = docs.withColumns({"id": F.lit("x"), "log_weight": F.lit("y"), "key": F.lit(1)})
    assert quality.resampled(clash, labels.withColumn("id", F.lit(0)), share=0.6).columns == ["doc_id", "log_weight", "key"]
    assert quality.resampled(clash, labels.withColumn("id", F.lit(0)), share=0.6).count() == 3


def test_noise_is_gumbel(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    k = np.array([r.key for r in quality.weighted(docs, np.zeros(quality.SLOTS)).collect()])
    assert abs(k.mean() - 0.5772) < 0.03 and abs(k.std() - np.pi / np.sqrt(6)) < 0.03
