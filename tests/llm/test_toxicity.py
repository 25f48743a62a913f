from __future__ import annotations

from itertools import product
from math import exp
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidepanel.llm import queries, toxicity


def by_enumeration(model, n, emitted):
    """Marginals by summing over all state sequences."""
    total, toxic = 0.0, [0.0] * n
    for states in product((0, 1), repeat=n):
        w = 1.0
        for i, s in enumerate(states):
            w *= (emitted.get(i, exp(model.bias))) if s else 1.0
            if i:
                w *= exp(model.moves[states[i - 1]][s])
        total += w
        for i, s in enumerate(states):
            toxic[i] += w * s
    return [t / total for t in toxic]


@pytest.mark.parametrize("seed", range(6))
def test_marginals_are_exact(seed):
    rng = np.random.default_rng(seed)
    model = toxicity.Field({}, float(rng.normal()), tuple(map(tuple, rng.normal(size=(2, 2)).tolist())))
    n = 11
    at = sorted(rng.choice(n, rng.integers(1, 6), replace=False).tolist())
    emitted = {i: exp(float(rng.normal(0, 2))) for i in at}
    want = by_enumeration(model, n, emitted)
    assert np.allclose(model.marginals(n, at, [emitted[i] for i in at]), [want[i] for i in at])


def test_gradient_ascent_learns_a_field():
    rng = np.random.default_rng(1)
    f = rng.integers(0, 6, (400, toxicity.SPAN))
    y = (f == 3).astype(np.int32)
    w, _, _ = toxicity.trained(f.reshape(-1), np.arange(f.size), y, np.ones(400), 6)
    assert w[3] > 3 and max(np.delete(w, 3)) < 1
    twice, _, _ = toxicity.trained(f[:200].reshape(-1), np.arange(f[:200].size), y[:200], np.full(200, 2.0), 6)
    same, _, _ = toxicity.trained(np.tile(f[:200].reshape(-1), 2), np.arange(f.size), np.tile(y[:200], (2, 1)), np.ones(400), 6)
    assert np.allclose(twice, same, atol=1e-6)


def test_gradient_is_that_of_the_likelihood(monkeypatch):
    """The first step of the ascent goes where the log likelihood, by enumeration, grows."""
    rng = np.random.default_rng(3)
    n, span = 4, 5
    x, at = rng.integers(0, n, 12), rng.integers(0, span, 12)
    y = rng.integers(0, 2, (1, span)).astype(np.int32)

    def likelihood(theta):
        w, bias, moves = theta[:n], theta[n], theta[n + 1 :].reshape(2, 2)
        own = bias + np.bincount(at, w[x], span)
        score = lambda s: sum(own[i] for i in range(span) if s[i]) + sum(moves[s[i - 1], s[i]] for i in range(1, span))
        return score(y[0].tolist()) - np.log(sum(np.exp(score(s)) for s in product((0, 1), repeat=span)))

    monkeypatch.setattr(toxicity, "STEPS", 1)
    monkeypatch.setattr(toxicity, "PENALTY", 0.0)
    w, bias, moves = toxicity.trained(x, at, y, np.ones(1), n)
    start = np.r_[np.zeros(n), -3.0, np.zeros(4)]
    step = np.r_[w, bias, moves.reshape(-1)] - start
    slope = np.array([(likelihood(start + 1e-5 * e) - likelihood(start - 1e-5 * e)) / 2e-5 for e in np.eye(len(start))])
    assert all(np.sign(a) == np.sign(b) for a, b in zip(step, slope) if abs(b) > 1e-6)


def test_windows_cover_all_tokens_with_features():
    chunks = ["plain"] * 40 + ["idiot"] * 30 + ["plain"] * 9 + ["moron"] + ["plain"] * 60
    known, starts = {"plain": [], "idiot": [0, 2], "moron": [1]}, []
    made = toxicity.windows_of(chunks, known, 1, lambda s: starts.append(s) or True)
    marked = {s + i for s, (_, _, y) in zip(starts, made) for i, state in enumerate(y) if state == 1}
    assert marked == {*range(40, 70), 79}
    assert all(len(x) == len(at) and len(y) == toxicity.SPAN for x, at, y in made)
    assert toxicity.windows_of([], {}, 1) == [] and len(toxicity.windows_of(chunks, known, 0, lambda s: s == 0)) == 1


def test_beginnings_must_say_more():
    assert toxicity.distinctive({"idiot": 20.0, "^idio": 20.0, "^idi": 19.0, "^chlla": 30.0, "^chl": 30.0, "chllax": 13.0, "^ver": 40.0, "vera": 15.0}) == ["^chlla", "^ver", "chllax", "idiot", "vera"]


def test_scores_of_a_hand_made_field():
    """Scores by summing over all state sequences, with features of neighbours."""
    model = toxicity.Field({"bad": (2.0, 0.7, -0.4), "^ba": (0.5, 0.0, 0.3)}, -1.0, ((0.2, -0.5), (-0.3, 0.4)), (1.5, 0.5, -2.0))
    text = "one bad two three bad bad four"
    chunks = text.split()
    known = {"bad": (2.0, 0.7, -0.4)}
    emitted = {}
    for i in range(len(chunks)):
        own = sum(known[chunks[i + d]][k] for k, d in enumerate((0, -1, 1)) if 0 <= i + d < len(chunks) and chunks[i + d] in known)
        emitted[i] = exp(-1.0 + own)
    want = by_enumeration(model, len(chunks), emitted)
    at, got = model.tagged(text)
    assert at == [0, 1, 2, 3, 4, 5, 6] and np.allclose(got, want)
    z = 1.5 * max(want) + 0.5 * np.log1p(sum(want)) - 2.0
    assert abs(model.score(got) - 1 / (1 + exp(-z))) < 1e-12


def auc(scores, labels):
    pos, neg = ([s for s, y in zip(scores, labels) if y == k] for k in (1, 0))
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def corpus(spark, n=3000):
    rng = np.random.default_rng(7)
    common = [f"{a}{b}" for a in ("th", "er", "on", "chan", "lost") for b in ("ing", "ed", "ly", "an", "ou", "er")]
    rows = []
    for i in range(n):
        words = rng.choice(common, rng.integers(5, 80)).tolist()
        if (y := int(i % 9 == 0)):
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(["idiot", "Moron,", f"chlla{rng.integers(0, 999)}x"])))
        rows.append((i, " ".join(words), y))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("text", F.translate("text", "0123456789", "abcdefghij"))


def test_held_out_accuracy_and_spans(spark):
    rows = corpus(spark).cache()
    model = toxicity.fit(rows.drop("toxic"), rows.select("doc_id", "toxic"))
    out = toxicity.scored(rows, model).join(rows.select("doc_id", "text", "toxic"), "doc_id").collect()
    held = [r for r in out if crc32(str(r.doc_id).encode()) % 5 == 0]
    assert auc([r.score for r in held], [r.toxic for r in held]) > 0.97
    assert all((r.score >= 0.5) == bool(r.toxic) for r in held)
    marked = [r.text[s.start : s.end].lower() for r in held for s in r.spans]
    assert marked and all(w.startswith(("idiot", "moron", "chlla")) for w in marked)
    kept = {r.doc_id for r in toxicity.clean(rows, model).collect()}
    assert not kept & {r.doc_id for r in held if r.toxic} and {r.doc_id for r in held if not r.toxic} <= kept


def plain_score(model, text):
    """Score and toxic tokens of a text: forward-backward over every token, in logs."""
    chunks = (text or "").lower().split()
    own = [[model.weights[f] for f in sorted(toxicity.features_of(w)) if f in model.weights] for w in chunks]
    added, weight = set(), [model.bias] * len(chunks)
    for i, features in enumerate(own):
        for k, step in enumerate((0, 1, -1)):
            if features and 0 <= i + step < len(chunks):
                weight[i + step] += sum(x[k] for x in features)
                added.add(i + step)
    if not added:
        return 1 / (1 + exp(-model.scale[2])), []
    n, moves = len(chunks), np.array(model.moves)
    e = np.array([[0.0, max(-60.0, min(60.0, w)) if i in added else w] for i, w in enumerate(weight)])
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = e[0]
    for i in range(1, n):
        ahead[i] = [np.logaddexp.reduce(ahead[i - 1] + moves[:, s]) + e[i, s] for s in (0, 1)]
    for i in range(n - 2, -1, -1):
        back[i] = [np.logaddexp.reduce(moves[s] + e[i + 1] + back[i + 1]) for s in (0, 1)]
    both = ahead + back
    toxic = np.exp(both[:, 1] - np.logaddexp.reduce(both, axis=1))
    p = [toxic[i] for i in sorted(added)]
    z = model.scale[2] + model.scale[0] * max(p) + model.scale[1] * np.log1p(sum(p))
    return 1 / (1 + exp(-z)), [i for i in sorted(added) if toxic[i] >= 0.5]


def test_whole_query_against_plain_scores(spark, tmp_path):
    """op9 over a small table with clashing columns: every score, decision and span by forward-backward over all tokens."""
    rows = corpus(spark, 900)
    odd = spark.createDataFrame([(9001, None), (9002, ""), (9003, "Idiot"), (9004, "lost " * 300 + "MORON, chllabx " + "ing " * 200)], "doc_id long, text string")
    docs = rows.select("doc_id", "text").union(odd).withColumns({"score": F.lit("mine"), "y": F.lit(3), "fold": F.lit(None).cast("int"), "spans": F.lit(0)})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows.select("doc_id", "toxic", F.lit("x").alias("text"), F.lit(1).alias("id")).write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op9_toxicity_crf(spark, str(tmp_path)).collect()
    own = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.fit(own, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    texts = {r.doc_id: r.text for r in own.collect()}
    assert model.weights and len(got) == len(texts) == 904
    for r in got:
        score, tokens = plain_score(model, texts[r.doc_id])
        assert abs(r.score - score) < 1e-9 and r.predicted == (score >= 0.5) and r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0)
        chunks = (texts[r.doc_id] or "").split()
        assert [texts[r.doc_id][s.start : s.end] for s in r.spans] == [chunks[i] for i in tokens]
    assert sum(r.predicted for r in got) > 80


def test_bounds_of_the_fit(spark):
    rows = corpus(spark, 600)
    labelled = toxicity.labelled(rows.drop("toxic"), rows.select("doc_id", "toxic"), 12_000, "doc_id", "text", "toxic")
    names = [["idiot", "moron", "^chlla"]] * (toxicity.FOLDS + 1)
    whole, some = (toxicity._windows(labelled, names, most) for most in (100_000, 30))
    for (_, _, y, n), (x, at, few, times) in zip(whole, some):
        assert len(y) > 30 == len(few) == len(times) and at.max() < 30 * toxicity.SPAN
        assert abs(times.sum() / n.sum() - 1) < 0.35  # a priority sample keeps the total, but for chance
    model = toxicity.fit(rows.drop("toxic"), rows.select("doc_id", "toxic"), features=2, windows=200)
    assert 0 < len(model.weights) <= 2


def test_held_out_labels_are_not_learnt(spark):
    rows = corpus(spark, 400)
    held = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")
    labels = rows.select("doc_id", "toxic")
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit(rows, x) for x in (labels, turned))
    assert a.weights == b.weights and a.scale == b.scale


def test_whole_table_and_odd_texts(spark, sf_dir):
    rows = queries.op9_toxicity_crf(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x" * 100_000), (3, "a " * 100_000), (3, "İdiot \x1c moron")], "doc_id long, text string")
    model = toxicity.Field({"moron": (9.0, 0.0, 0.0)}, -4.0, ((0.1, -1.0), (-1.0, 0.1)), (4.0, 1.0, -3.0))
    got = toxicity.scored(odd.withColumn("score", F.lit("mine")), model).collect()
    assert len(got) == 5 and sum(r.score > 0.5 for r in got) == 1
    none = odd.select("doc_id", F.lit(1).alias("toxic"))
    assert toxicity.fit(odd, none.limit(0)).weights == {} and toxicity.fit(odd.limit(0), none).weights == {}
