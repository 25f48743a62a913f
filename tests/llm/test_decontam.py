from __future__ import annotations

import random
import re

import pytest
from tidepanel.llm import decontam, queries


def shingles(words, n=5):
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def parts(text):
    """Question and answer (the last of several sentences) of an item."""
    found = [decontam.words_of(p) for p in re.split(r"(?<=[.!?])\s+|\n+", (text or "").strip())]
    found = [p for p in found if p]
    return ([w for p in found[:-1] for w in p], found[-1]) if len(found) > 1 else (found[0] if found else [], [])


def leaks(text, items):
    """Items of whose question and answer a text holds OVERLAP of the shingles each, anywhere."""
    words, out = decontam.words_of(text), set()
    for i, t in items.items():
        own = [shingles(p) for p in parts(t)]
        good = [len(p & shingles(words, len(next(iter(p))))) >= decontam.OVERLAP * len(p) for p in own if p]
        if good and all(good):
            out.add(i)
    return out


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    rows = queries.op5_benchmark_decontamination(spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(d, i) for d, t in texts.items() for i in leaks(t, items)}


def plain_scores(index, terms):
    out = {}
    for t in terms:
        items, impacts, *_ = index.postings(t)
        for i, x in zip(items, impacts):
            out[i] = out.get(i, 0.0) + x
    return out


@pytest.mark.parametrize("seed", range(8))
def test_block_max_wand_finds_what_a_full_scan_finds(seed, monkeypatch):
    monkeypatch.setattr(decontam, "POSTINGS", random.Random(seed).choice([1, 2, 7]))
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)]
    index = decontam.Index([(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 14)))) for i in range(150)])
    for _ in range(40):
        terms = sorted(rng.sample(range(len(index.codes)), rng.randint(1, min(25, len(index.codes)))))
        least = rng.choice([0.05, 0.2, 0.5, 0.9])
        want = {i: s for i, s in plain_scores(index, terms).items() if s >= least - 1e-9}
        got = dict(index.above(terms, least))
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


def test_edits_questions_and_blocks(spark, monkeypatch):
    words = [f"word{i}" for i in range(60)]
    item = " ".join(words[:40]) + "? " + " ".join(words[40:]) + "."
    filler = " ".join(f"other{i}" for i in range(500))
    texts = {1: f"{filler} {item.upper()} {filler}", 2: f"{filler} {' '.join(words[:20])} {filler}", 3: filler, 4: None, 5: "", 6: f"{filler} " + " ".join(words[:30] + ["x"] + words[31:]), 7: f"yes {filler}", 8: "a four word item"}
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "four word item"), (14, "yes"), (10, item)], "item_id long, text string")
    want = {(1, 10), (6, 10), (7, 14), (8, 13)}
    assert {(r.doc_id, r.item_id) for r in decontam.leaked(docs, items).collect()} == want
    kept = decontam.decontaminated(docs, items)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 4, 5}
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    assert {(r.doc_id, r.item_id) for r in decontam.leaked(docs, items).collect()} == want
    assert decontam.leaked(docs.limit(0), items).count() == 0 and decontam.leaked(docs, items.limit(0)).count() == 0


def test_question_without_its_answer_is_no_leak(spark):
    words = [f"word{i}" for i in range(60)]
    question, answer = " ".join(words[:50]), " ".join(words[50:])
    docs = spark.createDataFrame([(1, question + " and more"), (2, f"{answer} and more"), (3, f"{question} {answer}"), (4, f"{question} {' '.join(reversed(words[50:]))}")], "doc_id long, text string")
    items = spark.createDataFrame([("a", f"{question}? {answer}.")], "item_id string, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.leaked(docs, items).collect()] == [(3, "a")]


def test_odd_tables(spark):
    item = " ".join(f"word{i}" for i in range(30))
    long = "x " * 200_000 + item + " y" * 200_000
    docs = spark.createDataFrame([(1, long, "a", "b"), (1, long, "a", "b"), (None, item, None, None), (2, None, "x", None)], "doc_id long, text string, item_id string, word string")
    items = spark.createDataFrame([(5, item, 1), (5, item, 1), (None, item, None), (6, None, 2)], "item_id int, text string, doc_id int")
    rows = decontam.leaked(docs, items)
    assert rows.columns == ["doc_id", "item_id", "word", "score", "question", "answer"]
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in rows.collect()) == [(0, 0), (0, 5), (1, 0), (1, 0), (1, 5), (1, 5)]
    assert [r.doc_id for r in decontam.decontaminated(docs, items).collect()] == [2]
