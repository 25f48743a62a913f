from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tidepanel.llm import neardup, queries


def plain(texts, k):
    """n_shingles and component by comparing every pair that shares a shingle."""
    sets, held = {}, defaultdict(list)
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
        for s in sets[i]:
            held[s].append(i)
    both = Counter((a, b) for own in held.values() for n, a in enumerate(own) for b in own[n + 1 :])
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_minhash_neardup(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain(texts, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


@pytest.mark.parametrize("k", [2, 5])
def test_chains_and_groups(spark, monkeypatch, k):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(k)
    words = [f"w{i}" for i in range(4000)]
    texts, text = {}, rng.sample(words, 120)
    for i in range(60):  # a chain: neighbours are near, the ends are not
        texts[i] = " ".join(text)
        text = text.copy()
        text[rng.randrange(120)] = rng.choice(words)
        text[rng.randrange(120)] = rng.choice(words)
    for g in range(6):
        base = rng.sample(words, 8 + 20 * g)
        for c in range(25):
            copy = base.copy()
            for _ in range(rng.choice([0, 0, 1, g])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[100 + 25 * g + c] = " ".join(copy)
    texts |= {900: None, 901: "", 902: " \n", 903: "one", 904: "ONE", 905: "One\xa0x", 906: "a b", 907: "A\tb"}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, node int")
    rows = neardup.near_duplicates(docs, k=k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain(texts, k)


def test_repeated_null_and_empty(spark):
    docs = spark.createDataFrame([(5, "a b c"), (5, "a b c"), (None, "a b c"), (None, "z y"), (3, "A b c")], "doc_id long, text string")
    rows = sorted((r.doc_id or -1, r.component_id or -1) for r in neardup.near_duplicates(docs, k=2).collect())
    assert rows == [(-1, -1), (-1, 3), (3, 3), (5, 3), (5, 3)]
    assert neardup.near_duplicates(docs.limit(0), k=2).count() == 0


def test_registers_and_estimate():
    values = np.array([0, 1, 2, 3, 1 << 61, (1 << 62) - 1, 1 << 62, (1 << 55) + 5], np.uint64)
    made = neardup._register(values)
    lengths = [int(v).bit_length() for v in values]
    assert [int(m) >> 10 for m in made][1:6] == [62 - n for n in lengths[1:6]] and made[6] == 0xFFFF
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    keys = neardup.band_keys([np.unique(pool[:2400]), np.unique(pool[600:])])
    assert abs(neardup.estimated(keys[:1], keys[1:])[0] - 0.6) < 0.2


def test_rows_without_ids_go_too(spark):
    rows = [(5, "a b c"), (None, "a b c"), (None, "A b c"), (None, "z y"), (None, "z y"), (3, "q r s"), (None, ""), (None, None), (2**31 - 1, "u v w")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    left = [(r.doc_id, r.text) for r in neardup.deduplicated(docs, k=2).collect()]
    assert sorted(left, key=str) == sorted([(5, "a b c"), (None, "z y"), (3, "q r s"), (None, ""), (None, None), (2**31 - 1, "u v w")], key=str)
    words = [f"w{i}" for i in range(80)]
    near = [(1, " ".join(words)), (None, " ".join(words[:79])), (None, " ".join(words[1:]))]
    assert [r.doc_id for r in neardup.deduplicated(spark.createDataFrame(near, "doc_id long, text string")).collect()] == [1]
