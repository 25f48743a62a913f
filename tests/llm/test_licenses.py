from __future__ import annotations

import re

import pytest
from tidepanel.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, name) for p, name in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in found}))


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op4_license_scan(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows} == {i: plain(t) for i, t in texts.items()}
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in rows)


def plain_labels(text):
    """Labels and score of a text, by regular expressions and a recursive parser."""
    words = " ".join(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
    labels = {name: licenses.BINDS[licenses.family(name)] for p, name in {**licenses.BASE, **licenses.NOTICES}.items() if re.search(rf"(?:^| ){p}(?: |$)", words)}
    parts = []
    for line in re.findall(r"(?i)spdx-license-identifier:([^\n]*)", text or ""):
        all_ = re.match(r"(?:[ \t]*(?:[()]|[a-z0-9](?:[a-z0-9+]|[.-](?=[a-z0-9]))*))*", line.lower())[0]
        all_ = re.findall(r"[()]|[a-z0-9.+-]+", all_)

        def either(at):
            names, bind, at = both(at)
            while at < len(tokens) and tokens[at] == "or":
                more, other, at = both(at + 1)
                names, bind = names | more, min(bind, other)
            return names, bind, at

        def both(at):
            names, bind, at = single(at)
            while at < len(tokens) and tokens[at] == "and":
                more, other, at = single(at + 1)
                names, bind = names | more, 1 - (1 - bind) * (1 - other)
            return names, bind, at

        def single(at):
            if tokens[at] == "(":
                names, bind, at = either(at + 1)
                assert tokens[at] == ")"
                at += 1
            else:
                assert tokens[at] not in ("and", "or", "with", ")")
                names, bind, at = {tokens[at]}, licenses.BINDS.get(licenses.family(tokens[at]), licenses.UNKNOWN), at + 1
            while at < len(tokens) and tokens[at] == "with":
                more, _, at = single(at + 1)
                names, bind = names | more, 0.8 * bind
            return names, bind, at

        for stop in range(len(all_), -1, -1):  # the longest beginning that is an expression
            tokens = all_[:stop]
            try:
                names, bind, at = either(0)
                prose = stop < len(all_) and all_[stop] not in ("and", "or", "with", "(", ")")
                if at == stop and not (prose and any(t not in ("and", "or", "with", "(", ")") and not licenses.family(t) for t in tokens)):
                    break
                if at == stop:
                    stop = -1
                    break
            except (AssertionError, IndexError):
                continue
        if not stop or stop < 0:
            tokens = all_ if not stop else tokens
            names = {t for t in tokens if licenses.family(t)}
            bind = licenses.bound([licenses.BINDS[licenses.family(t)] for t in names])
        parts.append(bind)
        labels |= {n: 0.0 for n in names - labels.keys()}
    base = plain(text)[4]
    return ",".join(sorted({*labels, *filter(None, base.split(","))})), licenses.bound([*labels.values(), *parts])


def test_labels_and_scores_of_the_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op4_license_scan(spark, sf_dir).collect():
        labels, score = plain_labels(texts[r.doc_id])
        assert r.labels == labels and abs(r.score - score) < 1e-9


def test_labels_and_scores_of_expressions(spark):
    tag = "SPDX-License-Identifier: "
    texts = [f"{tag}{e}" for e in ("MIT", "(MIT OR GPL-2.0+) AND Zlib", "GPL-2.0 WITH Classpath-exception-2.0 OR MIT", "MIT OR", "(MIT", "nothing known", "", "A AND B WITH C OR D", "((MIT))", "MIT) OR BSD")]
    texts += [f"# {tag}MIT\nall rights reserved\n{tag}EUPL-1.2 AND (ISC or NCSA)", "word " * 200_000 + f"{tag}MIT"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "doc_id long, text string")
    rows = licenses.license_scan(docs).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        labels, score = plain_labels(texts[r.doc_id])
        assert (r.labels, round(r.score, 9)) == (labels, round(score, 9)), texts[r.doc_id][:80]


def test_edges(spark):
    texts = [None, "", "CC-BY cc by", "K cc\x00by", "All Rights\nReserved. all rights reserved", "GNU General Public License, version 3", "é cc by4 cc bÿ"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    for r in licenses.license_scan(docs).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
    assert licenses.license_scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("line", "labels", "score"),
    [
        ("<!-- SPDX-License-Identifier: MIT OR GPL-3.0-only -->", "gpl-3.0-only,mit", 0.1),
        ("/* SPDX-License-Identifier: MIT OR GPL-3.0-only */", "gpl-3.0-only,mit", 0.1),
        ("<!-- SPDX-License-Identifier: Foo-1.0-->", "foo-1.0", 0.5),
        ("SPDX-License-Identifier: MIT # a comment or more", "mit", 0.1),
        ("SPDX-License-Identifier: MIT.", "mit", 0.1),
        ("SPDX-License-Identifier: GPL-2.0+ and", "gpl-2.0+", 0.8),
        ("SPDX-License-Identifier: (MIT OR GPL-2.0) AND ISC) rest", "gpl-2.0,isc,mit", 0.19),
        ("SPDX-License-Identifier: (MIT OR", "mit", 0.1),
        ("SPDX-License-Identifier: -- MIT", "", 0.0),
    ],
)
def test_an_expression_ends_where_the_grammar_does(line, labels, score):
    got = licenses.scanned(line.encode())
    assert got[5] == labels and abs(got[6] - score) < 1e-9


def test_expressions():
    assert licenses.postfix("mit or apache-2.0 and bsd with x".split()) == ["mit", "apache-2.0", "bsd", "x", "with", "and", "or"]
    assert licenses.postfix(["(", "mit"]) is None and licenses.postfix(["mit", "mit"]) is None and licenses.postfix([]) is None
    names, easy = licenses.evaluated("MIT OR GPL-3.0-only")
    _, hard = licenses.evaluated("MIT AND (GPL-3.0-only)")
    assert names == {"mit", "gpl-3.0-only"} and easy < hard
    assert licenses.scanned(b"// SPDX-License-Identifier: Apache-2.0 OR MIT\ncode")[5] == "apache-2.0,mit"
    assert "gpl-3.0" in licenses.scanned(b"This work is licensed under the GNU General Public License, version 3.")[5]


def test_tags_of_any_case_and_family():
    for tag in ("SPDX-LICENSE-IDentifier:", "spdx-License-identifieR:"):
        got = licenses.scanned(f"é {tag} EUPL-1.2 OR MIT\n/* {tag} Artistic-2.0 WITH some-exception */".encode())
        assert got[5] == "artistic-2.0,eupl-1.2,mit,some-exception" and got[7] == ["eupl-1.2 or mit", "artistic-2.0 with some-exception"]
    assert licenses.evaluated("BSL-1.0 AND OFL-1.1") [0] == {"bsl-1.0", "ofl-1.1"} and licenses.evaluated("strange-1.0")[1] == licenses.UNKNOWN
    assert licenses.evaluated("see LICENSE, or MIT")[0] == set() and licenses.evaluated("MIT see LICENSE")[0] == {"mit"}
