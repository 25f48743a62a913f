from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidepanel.llm import fingerprints, queries
from tidepanel.llm.fingerprints import WIDTH


def shingles(text):
    return {text[i : i + WIDTH] for i in range(max(1, len(text) - WIDTH + 1))} if text else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_signature(text):
    """Each window on its own, with whole numbers."""
    weights = [int(w) for w in fingerprints._WEIGHTS]
    out = [0xFFFFFFFF] * fingerprints.PERMUTATIONS
    for s in shingles(text):
        h = sum(ord(c) * w for c, w in zip(s, weights)) + (len(s) * weights[WIDTH] if len(s) < WIDTH else 0)
        h = int(fingerprints._mixed(np.array([h % 2**64], np.uint64))[0]) >> 32
        out = [min(o, (h * int(a) + int(b)) % 2**32) for o, a, b in zip(out, fingerprints._A, fingerprints._B)]
    return np.array([o & 0xFFFF for o in out], np.uint16)


def check(rows, docs, hexed=False):
    """docs: (id, text) in order."""
    texts = [t or "" for _, t in docs]
    after = texts[1:] + texts[:1]
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(by) == len(docs)
    prints = fingerprints.signatures(texts)
    for (i, _), t, a, p, q in zip(docs, texts, after, prints, np.roll(prints, -1, 0)):
        r, m = by[i], len(t) // 4
        e = t[: len(t) - m] + a[:m]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        own, changed = (bytes.fromhex(x) if hexed else bytes(x) for x in (r.fingerprint, r.edited_fingerprint))
        assert own == p.tobytes()
        c = np.frombuffer(changed, np.uint16)
        assert (c == fingerprints.signatures([e])[0]).all()
        assert r.near_edited == (c == p).mean() and r.near_next == (p == q).mean()
        for near, other in ((r.near_edited, e), (r.near_next, a)):
            assert abs(near - jaccard(t, other)) < 6 * (0.25 / 128) ** 0.5


def test_whole_table(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    check(queries.op13_document_fingerprints(spark, sf_dir).collect(), docs, hexed=True)


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_odd_texts(spark, monkeypatch, parts):
    monkeypatch.setattr(fingerprints, "CHUNK", 40)
    monkeypatch.setattr(fingerprints, "AT_ONCE", 60)
    rng = random.Random(parts)
    texts = [None, "", "a", "abc", "abcd", "x" * 7, "x" * 8, "x" * 9, "", "naïve 日本 \U0001f600 text", "  ", "same text here", "same text here", "z" * 300, "last " * 40, None]
    texts += ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(200))) for _ in range(60)]
    docs = list(enumerate(texts, -5))
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rng.sample(docs, len(docs))], "doc_id int, text string, part string, head int").repartition(parts)
    rows = fingerprints.fingerprinted(frame).collect()
    check(rows, docs)
    assert fingerprints.fingerprinted(frame.limit(0)).count() == 0
    one = fingerprints.fingerprinted(frame.where("doc_id = 9")).collect()
    check(one, [(9, dict(docs)[9])])


def test_rows_without_an_id_or_with_the_same_one(spark):
    frame = spark.createDataFrame([(None, "first of all texts"), (None, "first of all texts"), (3, "third text, third"), (3, "third text, third"), (1, None)], "doc_id long, text string")
    rows = fingerprints.fingerprinted(frame).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in rows) == [(0, 18), (0, 18), (1, 0), (3, 17), (3, 17)]
    assert sorted(r.near_next for r in rows if r.doc_id is None) == [0.0, 1.0]


@pytest.mark.parametrize("text", ["", "short", "eight ch", "a text of some length, a text of some length", "\U0001f600 ünï"])
def test_signatures_window_by_window(text):
    assert (fingerprints.signatures([text])[0] == plain_signature(text)).all()


def test_signatures_of_pieces_and_batches(monkeypatch):
    texts = ["".join(random.Random(i).choice("abcdefgh ") for _ in range(i * 7)) for i in range(30)]
    whole = fingerprints.signatures(texts)
    monkeypatch.setattr(fingerprints, "CHUNK", 17)
    assert (fingerprints.signatures(texts) == whole).all() and all((fingerprints.signatures([t])[0] == w).all() for t, w in zip(texts, whole))


def test_matched_equals_all_pairs(spark):
    rng = random.Random(9)
    texts: dict[int, str | None] = {0: None, 1: "", 2: "tiny", 3: "tiny", 4: "tinY"}
    for g in range(12):
        base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(60 + 30 * g))
        for c in range(8):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice("xyz")
            texts[10 + 10 * g + c] = "".join(copy)
    top = {i: i for i in texts}

    def find(i):
        return i if top[i] == i else find(top[i])

    ids = list(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = shingles(texts[a]), shingles(texts[b])
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("node", F.lit(1))
    rows = fingerprints.matched(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(shingles(t)), find(i)) for i, t in texts.items()}
    assert len({r.component_id for r in rows}) < len(rows) - 20
