from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from tidepanel.llm import ann, queries


def exact(ids, x, k=10, every=100):
    """Nearest other ids of each id divisible by every: an id counts by its nearest row, and asks by its smallest vector."""
    out = {}
    for q in {i for i in ids.tolist() if i % every == 0}:
        own = min(x[ids == q].tolist())
        best = {}
        for i, d in zip(ids.tolist(), np.sqrt(((x - own) ** 2).sum(1)).tolist()):
            if i != q:
                best[i] = min(d, best.get(i, np.inf))
        out[q] = sorted(best.items(), key=lambda p: (p[1], p[0]))[:k]
    return out


def check(rows, want, least):
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = total = 0
    for q, near in want.items():
        assert [(s, v) for v, s in got[q]] == sorted((s, v) for v, s in got[q])
        hits += len({v for v, _ in near} & {v for v, _ in got[q]})
        total += len(near)
        scores = dict(near)
        assert all(abs(s - scores[v]) < 1e-12 for v, s in got[q] if v in scores)
    assert hits >= least * total


def test_whole_table(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    want = exact(t.vec_id.to_numpy(), np.stack(t.embedding).astype(float))
    check(queries.op3_adaptive_scan_ann(spark, sf_dir).collect(), want, 0.9)


def test_given_vectors_many_times_over(spark, sf_dir):
    """The given vectors, ten times, each with its own noise: many lists, no exhaustive search."""
    t = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    v = np.stack(t.embedding).astype(float)
    x = np.concatenate([v + 0.3 * v.std() * np.random.default_rng(k).standard_normal(v.shape) for k in range(10)])
    docs = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist()}))
    check(ann.nearest(docs).collect(), exact(np.arange(len(x)), x), 0.9)


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_with_many_lists(spark, monkeypatch, clustered):
    monkeypatch.setattr(ann, "BLOCK", 128)
    monkeypatch.setattr(ann, "QUERIES", 8)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3000, 32)) + (6 * rng.standard_normal((12, 32))[rng.integers(0, 12, 3000)] if clustered else 0)
    x[1000:2000] = x[7]  # a third of all vectors is one vector
    near = x[7] + 0.5 * rng.standard_normal((300, 32))  # and others stand beside it
    x = np.concatenate([x, near])
    docs = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(3300), "embedding": x.tolist()}))
    rows, want = ann.nearest(docs).collect(), exact(np.arange(3300), x)
    check(rows, want, 0.9)
    check([r for r in rows if r.query_id >= 3000], {q: w for q, w in want.items() if q >= 3000}, 0.9)


def test_scan_is_exact_without_tests(monkeypatch):
    monkeypatch.setattr(ann, "EPSILON", 1e9)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 40)).round(1)
    x[50:60] = x[3]
    ids = rng.integers(0, 300, 400)
    turn = ann.rotation(40)
    for i in range(20):
        d = {}
        for j, z in zip(ids.tolist(), np.sqrt(((x - x[i]) ** 2).sum(1)).tolist()):
            if j != ids[i]:
                d[j] = min(z, d.get(j, np.inf))
        want = sorted(d.items(), key=lambda p: (p[1], p[0]))[:7]
        for limit in (np.inf, want[-1][1]):
            at, got = ann.scanned(x[i], x[i] @ turn, x, x @ turn, ids, int(ids[i]), 7, limit)
            assert [int(j) for j in ids[at]] == [j for j, _ in want] and np.allclose(got, [z for _, z in want])


def test_repeated_rows_ties_and_other_columns(spark):
    rows = [(100, [0.0, 1.0])] * 14 + [(1, [0.0, 2.0])] * 3 + [(2, [1.0, 1.0]), (3, [0.0, 3.0]), (2, [9.0, 9.0]), (200, [5.0, 5.0]), (200, [4.0, 4.0])] + [(i, [0.5, 0.5]) for i in range(10, 40)]
    docs = spark.createDataFrame([(*r, 7, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, id int, list string, v double")
    want = exact(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))
    check(ann.nearest(docs).collect(), want, 1.0)
    check(ann.nearest(docs.toDF("list", "v", "id", "query_id", "embedding"), id_col="list", vector_col="v", k=3).collect(), {q: w[:3] for q, w in want.items()}, 1.0)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, None), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (8, [])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(docs).collect()] == [(0, 1, 1, 1.0)]
    assert ann.nearest(docs.limit(0)).count() == 0
    assert ann.nearest(docs.where("vec_id = 0")).count() == 0
