"""License scans: phrases and identifier tags by an Aho-Corasick automaton, licence expressions by a shunting-yard parser.

Texts are lower-cased in A-Z and cut into words of digits, letters a-z and characters beyond ASCII. One pass of the
automaton over the words finds all phrases, base and notice alike; a pass of another over the lower-cased text finds
``spdx-license-identifier:``, whose expression (up to the line's end) is parsed and evaluated.

The score says how much the found terms bind: for an expression, AND binds by all parts (1 - product of the rest),
OR by the least (the reader may choose), WITH by its licence, less a fifth; findings of a text combine like AND.

Defined results: a null or empty text has no words, null first_word and last_word, empty labels and score 0; each licence and
exception of an expression that parses is a label, whatever its name, a licence of an unknown family with a weight of 0.5; an
expression that does not parse gives the known licences named in it, as if joined by AND; very long texts are scanned whole; repeated rows
get equal results; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import leanly, slices

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "bsd license": "bsd",
    "cc by 4 0": "cc-by-4.0",
    "cc by nc": "cc-by-nc",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "eclipse public license": "epl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "affero general public license": "agpl",
    "lesser general public license": "lgpl",
    "isc license": "isc",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "the unlicense": "unlicense",
}
#: How much a licence family binds; the family of a label is the longest of these that it starts with.
BINDS = {
    "0bsd": 0.05, "afl": 0.3, "agpl": 0.9, "apache": 0.2, "artistic": 0.35, "bsd": 0.15, "bsl": 0.1, "busl": 0.9, "cc-by": 0.3, "cc-by-nc": 0.8, "cc-by-nd": 0.85, "cc-by-sa": 0.6, "cc0": 0.05,
    "cddl": 0.5, "cecill": 0.7, "curl": 0.1, "ecl": 0.2, "elastic": 0.9, "epl": 0.5, "eupl": 0.6, "gfdl": 0.7, "gpl": 0.8, "hpnd": 0.1, "isc": 0.1, "lgpl": 0.6, "libpng": 0.1, "licenseref": 0.5, "mit": 0.1,
    "mpl": 0.5, "ms-pl": 0.3, "ms-rl": 0.5, "ncsa": 0.15, "odbl": 0.6, "odc-by": 0.3, "ofl": 0.3, "openssl": 0.2, "osl": 0.7, "pddl": 0.05, "php": 0.2, "postgresql": 0.1, "psf": 0.15, "public-domain": 0.02,
    "python": 0.15, "reserved": 1.0, "ruby": 0.2, "sspl": 0.95, "unicode": 0.15, "unlicense": 0.05, "upl": 0.1, "vim": 0.2, "w3c": 0.15, "wtfpl": 0.05, "x11": 0.1, "zlib": 0.1, "zpl": 0.15,
}
#: How much a licence of another family binds.
UNKNOWN = 0.5
TAG = "spdx-license-identifier:"
RANK = {"or": 1, "and": 2, "with": 3}
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: A token, and what may stand before it: brackets, or names that begin and end with a letter, a digit or a plus.
_TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9](?:[a-z0-9+]|[.-](?=[a-z0-9]))*)")


def family(label: str) -> str | None:
    return max((f for f in BINDS if label == f or label.startswith((f + "-", f + "+"))), key=len, default=None)


def tokens_of(text: str) -> tuple[list[str], bool]:
    """The tokens of the longest expression that the text begins with (where none is complete, all tokens up to the first other sign), and whether a word follows, as in prose."""
    tokens, complete, operand_next, open_, at, end = [], 0, True, 0, 0, 0
    while m := _TOKEN.match(text, at):
        t = m[1]
        if t in RANK or t == ")":
            if operand_next or t == ")" and not open_:
                break
            open_ -= t == ")"
            operand_next = t != ")"
        else:
            if not operand_next:
                break
            open_ += t == "("
            operand_next = t == "("
        tokens.append(t)
        at = m.end()
        if not operand_next and not open_:
            complete, end = len(tokens), at
    after = _TOKEN.match(text, end) if complete else None
    return tokens[:complete] or tokens, bool(after and after[1] not in RANK and after[1] not in "()")


def postfix(tokens: list[str]) -> list[str] | None:
    """Operands and operators in postfix order, by precedence WITH, AND, OR; None if the tokens are no expression."""
    out, stack, operand_next = [], [], True
    for t in tokens:
        if t == "(":
            if not operand_next:
                return None
            stack.append(t)
        elif t == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif t in RANK:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and RANK[stack[-1]] >= RANK[t]:
                out.append(stack.pop())
            stack.append(t)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(t)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def evaluated(expression: str) -> tuple[set[str], float]:
    """Labels named in a licence expression, and how much it binds."""
    tokens, prose = tokens_of(expression.lower())
    order = postfix(tokens)
    if order is None or prose and not all(family(t) for t in tokens if t not in RANK and t not in "()"):
        known = {t for t in tokens if family(t)}
        return known, bound([BINDS[family(t)] for t in known])
    stack: list[tuple[set[str], float]] = []
    for t in order:
        if t not in RANK:
            stack.append(({t}, BINDS[f] if (f := family(t)) else UNKNOWN))
            continue
        (right, y), (left, x) = stack.pop(), stack.pop()
        if t == "with":
            stack.append((left | right, 0.8 * x))
        else:
            stack.append((left | right, min(x, y) if t == "or" else 1 - (1 - x) * (1 - y)))
    return stack[0]


def bound(parts: list[float]) -> float:
    rest = 1.0
    for p in parts:
        rest *= 1 - p
    return 1 - rest


@lru_cache(1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {**NOTICES, **BASE}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


@lru_cache(1)
def _tags():
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word(TAG, len(TAG))
    found.make_automaton()
    return found


def scanned(text: bytes) -> tuple:
    words = text.translate(_TABLE).split()
    line = b" " + b" ".join(words) + b" "
    base, labels, starts, at, n = set(), {}, [], 0, 0
    hits = sorted((end + 1 - len(p) - 2, p) for end, p in _automaton().iter(line.decode("latin-1")))
    for start, phrase in hits:
        n += line.count(b" ", at, start)
        at = start
        if phrase in BASE:
            base.add(BASE[phrase])
            starts.append(n)
        if (name := NOTICES.get(phrase) or BASE[phrase]) and (f := family(name)):
            labels[name] = BINDS[f]
    expressions, parts = [], []
    lower = text.lower()
    for last, _ in _tags().iter(lower.decode("latin-1")):
        end = lower.find(b"\n", last)
        line = lower[last + 1 : end if end >= 0 else len(lower)].decode("utf-8", "replace")
        named, binds = evaluated(line)
        expressions.append(" ".join(tokens_of(line)[0]))
        parts.append(binds)
        labels.update(dict.fromkeys(named - labels.keys(), 0.0))
    return (
        len(words),
        len(starts),
        starts[0] if starts else None,
        starts[-1] if starts else None,
        ",".join(sorted(base)),
        ",".join(sorted({*base, *labels})),
        float(bound([*labels.values(), *parts])),
        expressions,
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_base, first_word, last_word, base_labels, labels, score and expressions of each row."""

    def run(batches):
        for batch in slices(batches):
            columns = list(zip(*(scanned(t or b"") for t in batch.column(1).to_pylist()))) or [[]] * 8
            kinds = [*[pa.int64()] * 4, *[pa.string()] * 2, pa.float64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(
        leanly(run), f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>"
    )
    return out.withColumnRenamed("id", id_col)
