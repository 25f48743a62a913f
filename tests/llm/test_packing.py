from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tidepanel.llm import packing, queries, tokens


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokens.default_path())
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


def check(rows, texts, plain, size):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == texts.keys()
    for doc, own in by_doc.items():
        ids = plain(texts[doc]) + [0]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // size)))
        for r in own:
            part = ids[r.start : r.start + size]
            assert r.start == r.piece * size and r.length == len(part)
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence), -(-sum(r.length for r in rows) // size)


def test_whole_table(spark, sf_dir, plain):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    made, least = check(queries.op2_best_fit_packing(spark, sf_dir).collect(), texts, plain, 2048)
    assert made <= 1.02 * least + 1


def test_many_groups(spark, plain, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 20)
    texts = {i: "word " * (i % 37) for i in range(600)} | {600: None, 601: "", 602: "x " * 500}
    docs = spark.createDataFrame([(i, t, i) for i, t in texts.items()], "doc_id long, text string, length int")
    made, least = check(packing.pack(docs, size=64).collect(), texts, plain, 64)
    assert made <= 1.03 * least + 1


def test_empty_null_and_repeated(spark, plain):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    rows = packing.pack(docs).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 1), (1, 3), (1, 3)]
    assert packing.pack(docs.limit(0)).count() == 0


def test_sequences_hold_the_ids(spark, plain):
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(9)], "doc_id long, text string")
    rows = packing.sequences(packing.pack(docs, size=16, with_ids=True)).collect()
    whole = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in rows])
    assert sorted(whole.tolist()) == sorted(x for i in range(9) for x in plain("some words " * i) + [0])


@pytest.mark.parametrize("text", ["a\x1cb don't", "<|endoftext|>x", "ΑΣ ΣΑΣ ﬁ İé 12½² 'S !'s ''", "日本 テスト", "\x85x y", "é ́a", ""])
def test_ids_of_odd_texts(text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_path())
    plain.encode_special_tokens = True
    want = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    own = tokens.WordBpe(tokens.default_path())
    assert own.encode([text])[0] == want
    own.known.room = -1  # a full cache
    assert own.encode([f"{text} x", text])[1] == want


def test_best_fit_prefers_the_fullest_bin():
    bins, places = packing.best_fit(np.array([6, 5, 4, 5]), 10)
    assert bins[0] == bins[2] and bins[1] == bins[3] and places.tolist() == [0, 0, 6, 5]


def test_a_group_hands_on_all_its_open_bins():
    import pandas as pd

    size, n = 1024, 400
    lengths = np.random.default_rng(1).integers(1, 900, n)
    rows = pd.DataFrame({"bin": np.arange(n), "length": lengths, "cell": np.arange(n) % 8, "offset": 0, "final": False})
    first = [packing._packed(g, size, False, 1) for _, g in rows.groupby("cell")]
    for g in first:
        used = g.groupby("bin").length.sum()
        assert set(used[size - used > packing.SLACK].index) == set(g[~g.final].bin)
    rest = pd.concat(first)
    out = pd.concat([rest[rest.final], packing._packed(rest[~rest.final].assign(cell=0), size, True, 2)])
    assert len(out) == n and out.final.all() and out.groupby("bin").length.sum().max() <= size
    assert out.bin.nunique() <= 1.05 * packing.best_fit(lengths, size)[0].max() + 1


def test_bins_that_never_fill_end_the_rounds(spark, plain, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 10)
    texts = {i: "word " * 40 for i in range(200)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert check(packing.pack(docs, size=64).collect(), texts, plain, 64)[0] == 200


def test_many_small_rounds_lose_no_room(spark, plain, monkeypatch):
    """Groups far below the bins they leave open: as good as packing all at once."""
    monkeypatch.setattr(packing, "ITEMS", 25)
    rng = np.random.default_rng(5)
    texts = {i: "word " * int(n) for i, n in enumerate(rng.integers(5, 60, 1500))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    made, _ = check(packing.pack(docs, size=100).collect(), texts, plain, 100)
    whole = packing.best_fit(np.array([len(plain(t)) + 1 for t in texts.values()]), 100)[0].max() + 1
    assert made <= 1.02 * whole + 1
