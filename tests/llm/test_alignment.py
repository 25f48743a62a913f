from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from tidepanel.llm import alignment, queries

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = alignment.default_paths()
    first = Tokenizer.from_file(a)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=b)


def plain(texts, tools):
    """Each document by walking over its bytes one by one."""
    first, second = tools
    back = alignment._plain_bytes()
    docs, counts = [], Counter()
    for text in texts:
        if not text:
            docs.append(None)
            continue
        ids_a = first.encode(" " + text, add_special_tokens=False).ids
        ids_b = second.encode(text)
        raw_a = [bytes(back[c] for c in first.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [second.id_to_piece(i)]]
        if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            docs.append(None)
            continue
        of_a, of_b = ([k for k, r in enumerate(raw) for _ in r] for raw in (raw_a, raw_b))
        links = sorted(set(zip(of_a, of_b)))
        groups, own = [], ([], [])
        for at, (x, y) in enumerate(zip(of_a, of_b)):
            for side, k, ids in ((0, x, ids_a), (1, y, ids_b)):
                if not own[side] or own[side][-1][0] != k:
                    own[side].append((k, ids[k]))
            end_a, end_b = (at + 1 == len(of) or of[at + 1] != k for of, k in ((of_a, x), (of_b, y)))
            if end_a and end_b:
                groups.append("|".join(",".join(str(i) for _, i in side) for side in own))
                own = ([], [])
        pairs = [(ids_a[x], ids_b[y]) for x, y in links]
        counts.update(pairs)
        docs.append((len(ids_a), len(ids_b), len(groups), pairs, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(n, top.get(y, 0))
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (*d[:3], len(d[3]), sum(counts[p] == top[p[1]] for p in d[3]), sum(counts[p] for p in d[3]), d[4]) for d in docs]


def test_whole_table(spark, sf_dir, tools):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_token_alignment(spark, sf_dir).collect()}
    assert got == dict(zip(texts, plain(texts.values(), tools)))


ODD = ["", None, " ", "a", "a  b", "  two", "end ", "tab\tline\nline\r\n\r\n  x", "<|endoftext|> <s> </s> <unk> <0x41>", "▁under▁", "don't 'S we'll", "日本 テスト 한국", "é é ﬁ ² ½ Ⅷ", "\U0001f600\U0001f469‍\U0001f4bb x", "\x00\x01\x7f", "١٢٣ ߀ ᠀", "ǅ ԱՕ ჯ", "x" * 900, " " * 900, "1" * 900, "!?" * 500, "͸׿\U000e0001", "same words same words", "same words same words"]


@pytest.mark.parametrize("frequent", [1 << 18, 40, 0])
def test_odd_texts(spark, tools, frequent):
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(ODD)] + [(None, "no id", 0, "x")], "doc_id int, text string, row long, pair_n string")
    rows = alignment.token_alignment(docs, frequent=frequent).collect()
    want = plain([*ODD, "no id"], tools)
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == dict(zip([*range(len(ODD)), None], want))
    assert sum(w[0] == 0 for w in want) >= 3 and sum(w[0] > 0 for w in want) > 15
    assert alignment.token_alignment(docs.limit(0)).count() == 0


def test_long_texts_are_cut_without_a_trace(spark, tools, monkeypatch):
    rng = random.Random(3)
    words = ["tide", "panel,", "42", "\n", "naïve", "don't", "日本", "internationalisation", "  ", "a-b", "\t"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 60, 900, 4000)] + ["▁ mark at the end " + "some words " * 400, "some words " * 400 + "▁"]
    monkeypatch.setattr(alignment, "LONG", 50)
    monkeypatch.setattr(alignment, "AT_ONCE", 300)
    monkeypatch.setattr(alignment, "PAIRS", 40)
    own = alignment.sides(*alignment.default_paths())
    assert len(own.cut(texts[2])) > 20 and "".join(own.cut(texts[2])) == " " + texts[2]
    bad, done = set(), {}
    for of, made in alignment._aligned(own, texts, bad):
        part, pair, number = made.pairs(own)
        groups = made.written(own)
        for k, i in enumerate(of):
            done.setdefault(i, alignment._Doc()).add([(made.part_a == k).sum(), (made.part_b == k).sum(), made.groups[k], made.links[k]], groups[k], pair[part == k], number[part == k])
    want = plain(texts, tools)
    assert bad == {i for i, w in enumerate(want) if not w[0]} == {4, 5}
    for i, w in enumerate(want):
        if i not in bad:
            assert (*done[i].counts.tolist(), done[i].digest.hexdigest()) == (*w[:4], w[6]) and done[i].merged()[1].sum() == w[3]


def test_tokens_groups_and_links(spark, tools):
    text = "tokenization of naïve words"
    row = alignment.alignments(spark.createDataFrame([(7, text), (8, None)], "doc_id long, text string")).where("doc_id = 7").first()
    first, second = tools
    assert row.a == first.encode(" " + text).ids and row.b == second.encode(text)
    back = alignment._plain_bytes()
    raw_a = [bytes(back[c] for c in first.id_to_token(i)) for i in row.a]
    raw_b = [second.id_to_piece(i).replace("▁", " ").encode() for i in row.b]
    for g in range(row.group_a[-1] + 1):
        assert b"".join(r for r, x in zip(raw_a, row.group_a) if x == g) == b"".join(r for r, x in zip(raw_b, row.group_b) if x == g)
    of_a, of_b = ([k for k, r in enumerate(raw) for _ in r] for raw in (raw_a, raw_b))
    assert sorted(zip(row.link_a, row.link_b)) == sorted(set(zip(of_a, of_b)))


def test_very_long_runs(tools):
    own = alignment.sides(*alignment.default_paths())
    for text in ("x" * 300_000, " " * 300_000, "word " * 60_000):
        assert own.first([text])[0] == tools[0].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["x " * 150 + "y" * n + " z" * 150 for n in (399, 400, 401)] + ["x " * 151 + "y" * n for n in (399, 400)] + ["a b" * 99 + "\t" * n + "c d" * 99 for n in (399, 400, 650)] + ["", "a\nb" * 500, "word " * 90, "x" * 399, " " * 400])
def test_runs(text):
    assert alignment._runs(text) == (max([0, *map(len, text.split())]) >= 400 or " " * 400 in text.replace("\t", " ").replace("\n", " "))


def test_aligning_takes_less_than_encoding(tools, spark, sf_dir):
    """CPU seconds of everything but the two libraries, as a share of theirs."""
    from time import process_time

    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    own, shares = alignment.sides(*alignment.default_paths()), []
    own.second(texts[:1])
    for _ in range(3):
        began = process_time()
        for t in texts:
            own.fast.encode_to_numpy(" " + (t or ""))
        own.second([t or "" for t in texts])
        alone, began = process_time() - began, process_time()
        for _, made in alignment._aligned(own, texts, set()):
            made.written(own), made.pairs(own)
        shares.append((process_time() - began) / alone - 1)
    assert min(shares) < 0.8, shares
