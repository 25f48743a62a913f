from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F
from tidepanel.llm import pii, queries


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    found = []
    for k, (kind, pattern) in enumerate(pii.BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), k, m.end(), kind))
    return sorted(found)


def check(rows, texts):
    for r in rows:
        found = plain(texts[r.doc_id])
        counts = [sum(f[3] == k for f in found) for k in pii.BASE]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, (r.doc_id, texts[r.doc_id][:300])
        named = [f"{k}:{s}:{e}" for s, _, e, k in found]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(named) <= set(spans)
        places = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in spans]
        assert places == sorted(places)


def test_whole_table(spark, sf_dir):
    rows = queries.op7_pii_spans(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    check(rows, texts)


ODD = [
    None, "", "a@b.c_d@e.f x@y.zz.", "1.2.3.4.5.6.7.8 999.1.1.1 0000255.1.1.1 1.2.3", "4111 1111 1111 1111 1", "4111-1111-1111-1111", "4111  1111 1111 1111",
    "41111111111111111111111111", "+1 (743) 555-3824, +1 2 +12345678901234567 +49-30-12 34 56 78)", "@ 41111111 1111 1111 a@b.co",
    "é😀 me@site.example.com 10.0.0.1", "1 " * 40_000, "1" * 100_000, "a" * 100_000 + "@", "a" * 50_000 + "@b.cd " * 300, "x@" * 500, "1." * 5000, "+" * 999, "+1" + "-" * 50_000,
    'token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2"', "(743) 555-3824", "DE89370400440532013000",
]


def test_odd_texts_and_columns(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(ODD)], "doc_id long, text string, email string, candidates int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check(queries.op7_pii_spans(spark, str(tmp_path)).collect(), dict(enumerate(ODD)))
    empty = f"{tmp_path}/empty"
    docs.limit(0).write.parquet(f"{empty}/documents.parquet")
    assert queries.op7_pii_spans(spark, empty).count() == 0


def test_many_matches_in_one_text(spark):
    texts = [f"{'a1 ' * n}me@site.example.com 10.0.0.1 " * 3 + "x@y.zz " * n for n in (0, 1, 127, 128, 129, 255, 256, 257, 5000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] * 2, "doc_id long, text string")
    found = pii.personal_data(docs)
    for r in found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE], pii.joined("_base").alias("base"), pii.joined("spans").alias("spans")).collect():
        assert r.base == ",".join(f"{k}:{s}:{e}" for s, _, e, k in plain(texts[r.doc_id]))


def test_spans_that_the_model_adds(spark):
    """Keys beside a naming word teach the trees to take keys of that look without one, and to leave words alone."""
    rng = random.Random(4)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(30))
    texts = [f'first token = "{key()}" then' for _ in range(300)] + [f"such a {word()} is no key" for _ in range(300)] + [f'other = "{key()}" 10.0.0.1' for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.spans for r in pii.personal_data(docs).select("doc_id", pii.joined("spans").alias("spans")).collect()}
    for i, t in enumerate(texts):
        want = [f"secret:{m.start()}:{m.end()}" for m in re.finditer(r"(?<=\")[0-9a-f]{40}", t)] + [f"ip:{m.start()}:{m.end()}" for m in re.finditer(r"10\.0\.0\.1", t)]
        assert out[i] == ",".join(want), t


def test_chosen_spans_against_plain_trees(spark, sf_dir):
    """The SQL of the trees, limits, overlaps and order against the same model walked through in Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = pii.written(pii.candidates(pii.base_spans(docs.select("doc_id", "text"))).select("doc_id", *pii.BASE, "candidates"), "candidates")
    rows = [tuple(int(rng.random() * 4) for _ in pii.FEATURES) for rng in [random.Random(i) for i in range(60)]]
    trees, score = [], [0.0] * 60
    data = [(r, 10.0, float(10 * (sum(r) % 2))) for r in rows]
    for _ in range(3):
        trees.append(pii._grow(data, score))
        score = [s + pii._value(trees[-1], r) for s, r in zip(score, rows)]
    model = "(0.1D" + "".join(f" + {pii._sql(t)}" for t in trees) + ")", {1: 0.05, 4: 0.0, 5: 0.1, 6: -9.0, 7: -9.0}
    for r in pii.chosen(found, model).select("doc_id", "candidates", "_base", "spans").collect():
        base = [(b.start, b.kind, b.end) for b in r._base]
        value = lambda x: 0.1 + sum(pii._value(t, tuple(x[f] for f in pii.FEATURES)) for t in trees)
        more, to = [], 0
        for x in sorted(((x.start, x.kind, x.end) for x in r.candidates if value(x) >= model[1][x.kind] - 1e-7)):
            if not any(s < x[2] and x[0] < e for s, _, e in base) and x[0] >= to:
                more.append(x)
                to = x[2]
        assert [(s.start, s.kind, s.end) for s in r.spans] == sorted(base + more)


def test_redaction(spark):
    texts = ["write me@site.example.com or +1 (743) 555-3824 now", "nothing here", None, "ip 10.0.0.1."]
    docs = spark.createDataFrame([(i, t, "en", 7) for i, t in enumerate(texts)], "doc_id long, text string, lang string, spans int")
    out = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert pii.redacted(docs).columns == docs.columns
    assert [out[i].text for i in range(4)] == ["write [email] or [phone] now", "nothing here", None, "ip [ip]."]
    assert out[0].spans == 7


def test_trees_tell_bins_apart():
    rows = [((0, d, 0, 0, 0, 0, 0, 0, 0, 0), 100.0, 95.0 if d > 3 else 2.0) for d in range(8)]
    tree = pii._grow(rows, [0.0] * 8)
    assert tree[0] == (1, 4) and pii._value(tree, rows[7][0]) > 0 > pii._value(tree, rows[0][0])
