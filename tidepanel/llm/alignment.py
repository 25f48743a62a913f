"""Alignment of two tokenizers over the same texts, by byte offsets.

Tokens of both sides lie on the bytes of a space and the text. In each batch pandas merge_asof, by positions that count on from
document to document, finds for every token start the token of the other side that covers it; both directions together are the overlaps (links), and offsets
where tokens of both sides end cut a document into groups. Links are counted by pair of ids over all documents: pairs that
occur often are looked up in a broadcast table of at most FREQUENT rows, all others meet their counts in a join by pair,
where no pair has many rows.

Long texts are cut between two words, where a token of either side must end, and aligned piece by piece.

Defined results: null and empty texts, and texts that the tokens of either side do not give back byte by byte, have no
tokens (zeros and an empty digest); rows are aligned each, even if they repeat or lack an id; special strings are plain
text; other columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import leanly, model, slices, written

#: Characters from which on a text is cut, characters aligned at a time, and pairs and rows of an output batch.
LONG, AT_ONCE, PAIRS, ROWS = 1 << 16, 1 << 18, 1 << 18, 1024
#: Rows of the broadcast table of frequent pairs.
FREQUENT = 1 << 18
#: Letters, marks and symbols that all versions of Unicode class alike; texts of these alone may take the faster encoder.
_USUAL = re.compile(r"[\x00-ʯΑ-ΡΣ-ϿА-я‐-‧€ぁ-ゖァ-ヺ一-龥가-힣]*")
#: Runs without a break from which on the faster encoder takes long.
RUN = 400
_SPACES = re.compile(rf"\s{{{RUN}}}")
_HALF = RUN // 2  # every run of RUN characters holds one of the text's blocks of so many
_BETWEEN = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def _plain_bytes() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Names:
    """Byte strings by number, as one array."""

    def __init__(self, names: list[bytes]) -> None:
        self.sizes = np.array([len(x) for x in names], np.int64)
        self.begins, self.flat = self.sizes.cumsum() - self.sizes, np.frombuffer(b"".join(names), np.uint8)

    def joined(self, numbers: np.ndarray, stops: np.ndarray) -> list[bytes]:
        """The strings of numbers up to the first stop, from there to the next one, and so on."""
        sizes = self.sizes[numbers]
        ends = np.r_[0, sizes.cumsum()]
        raw = self.flat[np.repeat(self.begins[numbers] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        at = ends[stops].tolist()
        return [raw[i:j] for i, j in zip([0, *at[:-1]], at)]


class Sides:
    """Both vocabularies: ids of texts, and the bytes of each id."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(byte_level)
        self.tokenizer.encode_special_tokens = True
        back, vocabulary = _plain_bytes(), self.tokenizer.get_vocab()
        special = {i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a[i] = token.encode() if i in special else bytes(back[c] for c in token)
        self.fast = self._same_ranks(byte_level)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        n = self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(i) for i in range(n)]
        self.b = [bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.cuts = not any("▁" in p.lstrip("▁") for p in names)
        self.names = _Names(self.a), _Names(self.b)
        self.width = max(1, (len(self.b) - 1).bit_length())  # bits of an id of the second side
        self.texts = _Names([s for i in range(len(self.a)) for s in (b"%d," % i, b"%d|" % i)] + [s for i in range(n) for s in (b"%d," % i, b"%d;" % i)])

    def _same_ranks(self, byte_level: str):
        """The same vocabulary as ranks for the other library, if it lies beside it and agrees on every id."""
        path = os.path.splitext(byte_level)[0] + ".tiktoken"
        if not os.path.exists(path):
            return None
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        if any(i >= len(self.a) or self.a[i] != token for token, i in ranks.items()):
            return None
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def first(self, texts: list[str]) -> list[list[int]]:
        """ids of texts as they stand, by the byte-level vocabulary."""
        return [ids.tolist() for ids in self.first_arrays(texts)]

    def first_arrays(self, texts: list[str]) -> list[np.ndarray]:
        usual = [self.fast is not None and not _runs(t) and (t.isascii() or _USUAL.fullmatch(t) is not None) for t in texts]
        out = [self.fast.encode_to_numpy(t) if u else None for t, u in zip(texts, usual)]
        rest = [i for i, u in enumerate(usual) if not u]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False) if rest else []):
            out[i] = np.array(e.ids, np.int64)
        return out

    def second(self, texts: list[str]) -> list[list[int]]:
        """ids of a space and each text, by the vocabulary of pieces, which adds the space."""
        return self.pieces.encode(texts, num_threads=1)

    def cut(self, text: str) -> list[str]:
        """A space and the text in parts; all begin with a space between two words."""
        text, parts, start = " " + text, [], 0
        while self.cuts and len(text) - start > LONG:
            at = _BETWEEN.search(text, start + LONG)
            if not at:
                break
            parts.append(text[start : at.start()])
            start = at.start()
        return [*parts, text[start:]]


@model
def sides(byte_level: str, pieces: str) -> Sides:
    return Sides(byte_level, pieces)


def _runs(text: str) -> bool:
    if len(text) < RUN:
        return False
    blocks = [text[i : i + _HALF] for i in range(0, len(text) - _HALF + 1, _HALF)]
    if all(" " in x and not x.isspace() for x in blocks):
        return False
    return max(map(len, text.split()), default=0) >= RUN or _SPACES.search(text) is not None


def _joined(names: _Names, ids: list[np.ndarray]) -> list[bytes]:
    return names.joined(np.concatenate(ids).astype(np.int64), np.cumsum([len(x) for x in ids])) if ids else []


class Aligned:
    """Tokens of some parts of texts, their links and groups; positions count over all parts."""

    def __init__(self, own: Sides, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        n = len(a)
        self.a, self.b = (np.concatenate(side).astype(np.int64) for side in (a, b))
        self.part_a, self.part_b = (np.repeat(np.arange(n), [len(ids) for ids in side]) for side in (a, b))
        size_a, size_b = (names.sizes[ids] for names, ids in zip(own.names, (self.a, self.b)))
        start_a, start_b = size_a.cumsum() - size_a, size_b.cumsum() - size_b
        # a part has as many bytes on both sides, so positions of all parts need no key
        left = pd.DataFrame({"at": start_a, "token": np.arange(len(start_a))})
        right = pd.DataFrame({"at": start_b, "token": np.arange(len(start_b))})
        over_a = pd.merge_asof(left, right, on="at")["token_y"].to_numpy(np.int64)
        over_b = pd.merge_asof(right, left, on="at")["token_y"].to_numpy(np.int64)
        begins_a, begins_b = start_b[over_a] == start_a, start_a[over_b] == start_b  # where tokens of both sides begin, a group does
        new = ~begins_b  # equal starts are in the first direction
        self.link_a, self.link_b = np.r_[np.arange(len(start_a)), over_b[new]], np.r_[over_a, np.flatnonzero(new)]
        self.group_a, self.group_b = begins_a.cumsum() - 1, begins_b.cumsum() - 1
        last_a = np.r_[self.group_a[1:] != self.group_a[:-1], True]
        self.groups = np.bincount(self.part_a[last_a], minlength=n)
        self.links = np.bincount(self.part_a[self.link_a], minlength=n)
        self.last_a, self.last_b = last_a, np.r_[self.group_b[1:] != self.group_b[:-1], True]

    def written(self, own: Sides) -> list[bytes]:
        """For each part its groups as text: ids of both sides in order, a semicolon after each group."""
        n = len(self.a) + len(self.b)
        keys = np.empty(n, np.int64)
        keys[np.arange(len(self.a)) + np.searchsorted(self.group_b, self.group_a, "left")] = 2 * self.a + self.last_a
        keys[np.arange(len(self.b)) + np.searchsorted(self.group_a, self.group_b, "right")] = 2 * (len(own.a) + self.b) + self.last_b
        parts = len(self.groups)
        stops = (np.bincount(self.part_a, minlength=parts) + np.bincount(self.part_b, minlength=parts)).cumsum()
        return own.texts.joined(keys, stops)

    def pairs(self, own: Sides) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Part, pair of ids (the first one's id times 2^width and the second one's) and number of links, for each part and pair once."""
        pair = (self.a[self.link_a] << own.width) | self.b[self.link_b]
        bits = own.width + max(1, (len(own.a) - 1).bit_length())
        codes, counts = np.unique((self.part_a[self.link_a] << bits) | pair, return_counts=True)
        return codes >> bits, codes & ((1 << bits) - 1), counts


def _faithful(own: Sides, parts: list[str]) -> tuple[list[bool], list[np.ndarray], list[np.ndarray]]:
    """Whether the tokens of both sides give a part back, and its tokens."""
    a, b = own.first_arrays(parts), [np.array(ids, np.int64) for ids in own.second([p[1:] for p in parts])]
    raw = [p.encode("utf-8", "surrogatepass") for p in parts]
    return [x == y == r for x, y, r in zip(*(_joined(names, ids) for names, ids in zip(own.names, (a, b))), raw)], a, b


def _units(own: Sides, texts: list[str | None]) -> Iterator[list[tuple[int, str]]]:
    """(text number, part) of all texts that are not empty, AT_ONCE characters at a time."""
    unit, size = [], 0
    for i, text in enumerate(texts):
        for part in own.cut(text) if text else []:
            if unit and size + len(part) > AT_ONCE:
                yield unit
                unit, size = [], 0
            unit.append((i, part))
            size += len(part)
    if unit:
        yield unit


def _aligned(own: Sides, texts: list[str | None], bad: set[int]) -> Iterator[tuple[list[int], Aligned]]:
    """Text numbers of parts and their alignment; texts that are not given back are added to bad, and their other parts do not count."""
    for unit in _units(own, texts):
        unit = [(i, p) for i, p in unit if i not in bad]
        good, a, b = _faithful(own, [p for _, p in unit])
        bad.update(i for (i, _), g in zip(unit, good) if not g)
        kept = [k for k, (i, _) in enumerate(unit) if i not in bad]
        if kept:
            yield [unit[k][0] for k in kept], Aligned(own, [a[k] for k in kept], [b[k] for k in kept])


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def alignments(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids of both sides (a, b), the group of each token (group_a, group_b, from 0), and links as token numbers (link_a, link_b)."""
    paths = tuple(given or own for given, own in zip((byte_level, pieces), default_paths() if not (byte_level and pieces) else (None, None)))
    names = ["a", "b", "group_a", "group_b", "link_a", "link_b"]

    def run(batches):
        own = sides(*paths)
        for batch in slices(batches, 64):
            texts, bad = batch.column(1).to_pylist(), set()
            out: list[dict[str, list]] = [{c: [] for c in names} for _ in texts]
            for of, made in _aligned(own, texts, bad):
                first = {"a": np.searchsorted(made.part_a, np.arange(len(of))), "b": np.searchsorted(made.part_b, np.arange(len(of)))}
                for k, i in enumerate(of):
                    row, at_a, at_b, links = out[i], made.part_a == k, made.part_b == k, made.part_a[made.link_a] == k
                    base = 1 + int(row["group_a"][-1][-1]) if row["group_a"] else 0
                    before = [sum(map(len, row["a"])) - first["a"][k], sum(map(len, row["b"])) - first["b"][k]]
                    low = made.group_a[at_a][0]
                    values = made.a[at_a], made.b[at_b], made.group_a[at_a] - low + base, made.group_b[at_b] - low + base, made.link_a[links] + before[0], made.link_b[links] + before[1]
                    for c, v in zip(names, values):
                        row[c].append(v)
            columns = [[np.concatenate(r[c]) if r[c] and i not in bad else np.empty(0, np.int64) for i, r in enumerate(out)] for c in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.list_(pa.int64())) for c in columns)], names=[id_col, *names])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(leanly(run, sides), f"`{id_col}` {kind}, " + ", ".join(f"{c} array<long>" for c in names))


_SUMMARY = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair_a array<int>, pair_b array<int>, pair_n array<int>"


class _Doc:
    """What is known of a text whose parts come one by one."""

    def __init__(self) -> None:
        self.counts, self.digest, self.begun = np.zeros(4, np.int64), hashlib.sha256(), False
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, counts: list[int], groups: bytes, pairs: np.ndarray, numbers: np.ndarray) -> None:
        self.counts += counts
        self.digest.update(b";" + groups[:-1] if self.begun else groups[:-1])
        self.begun = True
        self.pairs.append((pairs, numbers))
        if len(self.pairs) > 32:
            self.pairs = [self.merged()]

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0]
        pairs, at = np.unique(np.concatenate([p for p, _ in self.pairs] or [np.empty(0, np.int64)]), return_inverse=True)
        return pairs, np.bincount(at, np.concatenate([n for _, n in self.pairs] or [np.empty(0)]), len(pairs)).astype(np.int64)


def summaries(docs: DataFrame, byte_level: str, pieces: str, id_col: str, text_col: str) -> DataFrame:
    """A row per document: numbers of tokens, groups and links, the digest of its groups, and its pairs of ids with their numbers of links."""

    def emitted(own, rows, ids, done):
        pairs = [d.merged() for d in done]
        offsets = pa.array(np.cumsum([0, *(len(p) for p, _ in pairs)]), pa.int32())
        flat, numbers = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (flat >> own.width, flat & ((1 << own.width) - 1), numbers)]
        counts = np.array([d.counts for d in done])
        digests = pa.array([d.digest.hexdigest() if d.begun else "" for d in done])
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), *(pa.array(counts[:, k]) for k in range(4)), digests, *lists], names=[f.split()[0] for f in _SUMMARY.split(", ")])

    def run(batches):
        own = sides(byte_level, pieces)
        for batch in slices(batches):
            rows, ids, texts = (batch.column(k).to_pylist() for k in range(3))
            done, bad, begun = [_Doc() for _ in texts], set(), 0
            held = 0
            for of, made in _aligned(own, texts, bad):
                n_a, n_b = (np.bincount(p, minlength=len(of)) for p in (made.part_a, made.part_b))
                groups, (part, pair, number) = made.written(own), made.pairs(own)
                at = np.searchsorted(part, np.arange(len(of) + 1))
                for k, i in enumerate(of):
                    done[i].add([n_a[k], n_b[k], made.groups[k], made.links[k]], groups[k], pair[at[k] : at[k + 1]], number[at[k] : at[k + 1]])
                held += len(pair)
                if held > PAIRS:  # texts before the last one are complete
                    ready = slice(begun, of[-1])
                    if begun < of[-1]:
                        yield emitted(own, rows[ready], ids[ready], [_Doc() if i in bad else done[i] for i in range(begun, of[-1])])
                        done[ready] = [None] * (of[-1] - begun)
                    begun, held = of[-1], len(pair)
            if begun < len(texts):
                yield emitted(own, rows[begun:], ids[begun:], [_Doc() if i in bad else done[i] for i in range(begun, len(texts))])

    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(leanly(run, sides), _SUMMARY)


def _pair() -> Column:
    return F.expr("pair_a * 4294967296L + pair_b").alias("pair")


def token_alignment(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document.

    A pair's count is the number of links of all documents between its two ids; n_best counts links of pairs whose count is the
    highest of their second id, count_sum adds up the counts of all links. frequent: rows of the broadcast table at most.
    """
    a, b = default_paths() if not (byte_level and pieces) else ("", "")
    rows = written(summaries(docs, byte_level or a, pieces or b, id_col, text_col), "alignments")
    zipped = F.inline(F.arrays_zip("pair_a", "pair_b", "pair_n"))
    links = rows.select("row", zipped).select("row", _pair(), F.col("pair_n").cast("long").alias("n"))
    counts = written(links.groupBy("pair").agg(F.sum("n").alias("count")), "counts")
    of = F.expr("pair & 4294967295L")
    top = counts.groupBy(of.alias("b")).agg(F.max("count").alias("top"))  # no more rows than the second vocabulary
    rated = counts.join(F.broadcast(top), of == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    least = _least(counts, frequent)
    often = F.broadcast(rated.where(F.col("count") >= least))
    found = links.join(often, "pair")
    if least > 1:
        rest = links.join(F.broadcast(counts.where(F.col("count") >= least).select("pair")), "pair", "left_anti")
        found = found.union(rest.join(rated.where(F.col("count") < least), "pair").select(*found.columns))
    sums = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    out = rows.drop("pair_a", "pair_b", "pair_n").join(sums, "row", "left")
    kind = docs.select(id_col).schema[0].dataType
    zero = F.lit(0).cast("long")
    return out.select(F.col("doc_id").cast(kind).alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def _least(counts: DataFrame, frequent: int) -> int:
    """The smallest power of two that at most so many pairs reach with their counts; at most 64 rows come to the driver."""
    sizes = dict(counts.groupBy(F.expr("int(floor(log2(count)))").alias("power")).agg(F.count("*")).collect())
    total, power = 0, max(sizes, default=0) + 1
    while power > 0 and total + sizes.get(power - 1, 0) <= frequent:
        power -= 1
        total += sizes.get(power, 0)
    return 1 << power
