"""Benchmark decontamination: every passage of every text queries a BM25 index of the test items.

The index's terms are word pairs, which ordinary prose shares far less often than words. A text's passages are
windows that overlap by half, long enough to hold any item of the index whole in one of them. Impacts are divided
by the score that an item gives itself, so one threshold serves all items: a passage must reach RETRIEVE of it. A bound
over the whole index (the sum of the terms' largest impacts) dismisses most passages; the others are searched by
block-max WAND, which returns every item above the threshold. An item counts as leaked if the passage holds at least
OVERLAP of its question's five-word shingles and OVERLAP of its answer's. The answer is the last sentence; an item of one sentence
is a question without an answer, and an item of one word leaks wherever the word stands.

The index is built in blocks of at most BLOCK_CHARS characters of items; each block is broadcast and passed over the
texts on its own, so what is broadcast does not grow with the benchmark.

Defined results: null or empty texts and items match nothing; an item or answer with fewer than five words matches where its
words stand together; rows that repeat give rows that repeat; repeated items count once; ids of items are whole numbers, or
else strings; very long texts are read whole, passage by passage; empty tables give no leak; other columns, whatever their
names, are ignored by leaked() and kept by decontaminated().
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import leanly, model, slices, written

RETRIEVE, OVERLAP, SHINGLE = 0.5, 0.8, 5
K1, B = 1.2, 0.75
POSTINGS = 32
BLOCK_CHARS = 4_000_000
_SPACES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SPACES).split()


class Index:
    """Items with BM25 impacts by word pair, in blocks of POSTINGS items with each block's largest impact.

    Postings of term t are first[t]:first[t + 1] of items (in order) and impacts.
    """

    def __init__(self, items: list[tuple[int | str | None, str | None]]) -> None:
        self.ids, words, cut = [], [], []
        for i, text in sorted(items, key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0, x[1] or "")):
            if own := words_of(text):
                n = len(words_of([p for p in _SENTENCE.split(text.strip()) if words_of(p)][-1]))
                self.ids.append(i)
                words.append(own)
                cut.append(len(own) - n if n < len(own) else len(own))
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.width = len(self.vocabulary) + 1
        coded = [np.array([self.vocabulary[w] for w in ws], np.int64) for ws in words]
        self.question = [shingled(c[:k]) for c, k in zip(coded, cut)]
        self.answer = [shingled(c[k:]) for c, k in zip(coded, cut)]
        self.longest = max(map(len, words), default=1)
        self.single: dict[int, list[int]] = {}
        for i, c in enumerate(coded):
            if len(c) == 1:
                self.single.setdefault(int(c[0]), []).append(i)
        terms = [Counter(self.terms(c).tolist()) for c in coded]
        n, held = len(terms), Counter(t for c in terms for t in c)
        mean = sum(sum(c.values()) for c in terms) / max(1, n)
        rows = []
        for i, c in enumerate(terms):
            k = K1 * (1 - B + B * sum(c.values()) / mean)
            impact = {t: log(1 + (n - held[t] + 0.5) / (held[t] + 0.5)) * f * (K1 + 1) / (f + k) for t, f in c.items()}
            whole = sum(impact.values())
            rows += [(t, i, x / whole) for t, x in impact.items()]
        rows.sort()
        of = np.array([r[0] for r in rows], np.int64)
        self.items, self.impacts = np.array([r[1] for r in rows], np.int32), np.array([r[2] for r in rows])
        self.codes, first = np.unique(of, return_index=True)
        self.first = np.r_[first, len(rows)].astype(np.int64)
        self.most = np.maximum.reduceat(self.impacts, first) if len(rows) else np.empty(0)

    def terms(self, coded: np.ndarray) -> np.ndarray:
        """Pairs of neighbours that are both in the vocabulary, as one number; -1 for others. A single word is its own pair."""
        if len(coded) == 1:
            return coded * self.width + self.width - 1
        a, b = coded[:-1], coded[1:]
        return np.where((a >= 0) & (b >= 0), a * self.width + b, -1)

    def postings(self, t: int) -> tuple[list[int], list[float], list[int], list[float]]:
        """Items and impacts of a term, and the last item and the largest impact of each block."""
        items, impacts = (x[self.first[t] : self.first[t + 1]] for x in (self.items, self.impacts))
        starts = np.arange(0, len(items), POSTINGS)
        return items.tolist(), impacts.tolist(), items[np.r_[starts[1:], len(items)] - 1].tolist(), np.maximum.reduceat(impacts, starts).tolist()

    def above(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """Block-max WAND: all items whose impacts over the terms (places in codes) sum to at least least."""
        lists = [self.postings(t) for t in terms]
        cursors = [[own[0][0], k, 0] for k, own in enumerate(lists)]  # current item, list, place in it
        most, found = [float(self.most[t]) for t in terms], []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, (_, own, _) in enumerate(cursors):
                bound += most[own]
                if bound >= least - 1e-9:
                    pivot = k
                    break
            if pivot is None:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block, end = 0.0, len(self.ids)
            for _, own, at in cursors[: pivot + 1]:
                ends = lists[own][2]
                k = min(bisect_left(ends, item, at // POSTINGS), len(ends) - 1)
                block += lists[own][3][k]
                if ends[k] >= item:  # else the list has nothing from here on
                    end = min(end, ends[k])
            if block < least - 1e-9:  # no item up to the first end of a block, or the next list's item, can do it
                to = min(end + 1, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.ids))
                self._move(lists, cursors, pivot, max(to, item + 1))
            elif cursors[0][0] == item:
                score = sum(lists[own][1][at] for _, own, at in cursors[: pivot + 1])
                if score >= least - 1e-9:
                    found.append((item, score))
                self._move(lists, cursors, pivot, item + 1)
            else:
                self._move(lists, cursors, pivot, item)
        return found

    def _move(self, lists: list[tuple], cursors: list[list], pivot: int, to: int) -> None:
        for c in cursors[: pivot + 1]:
            items = lists[c[1]][0]
            c[2] = bisect_left(items, to, c[2])
            c[0] = items[c[2]] if c[2] < len(items) else len(self.ids)
        cursors[:] = [c for c in cursors if c[0] < len(self.ids)]

    def leaks(self, text: str | None) -> list[tuple]:
        """item id, first word of the passage, BM25 share, overlaps of question and answer; the best passage of each item."""
        words = words_of(text)
        if not words or not len(self.codes):
            return []
        coded = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        out = self._single(coded)
        if len(coded) == 1:
            return out
        terms = self.terms(coded)
        place = np.searchsorted(self.codes, terms)
        place[place == len(self.codes)] = 0
        hit = np.flatnonzero(self.codes[place] == terms)
        if not len(hit):
            return out
        total = np.r_[0.0, np.cumsum(self.most[place[hit]])]
        span, step = 2 * self.longest, self.longest
        starts = np.arange(0, max(1, len(words) - step), step)
        first, stop = np.searchsorted(hit, starts), np.searchsorted(hit, starts + span - 1)
        best: dict[int, tuple] = {}
        for k in np.flatnonzero(total[stop] - total[first] >= RETRIEVE - 1e-9).tolist():
            s = int(starts[k])
            passage = coded[s : s + span]
            for item, score in self.above(np.unique(place[hit[first[k] : stop[k]]]).tolist(), RETRIEVE):
                q, a = (share(x[item], passage) for x in (self.question, self.answer))
                if q >= OVERLAP and a >= OVERLAP and (item not in best or score > best[item][2]):
                    best[item] = (self.ids[item], s, float(score), q, a)
        return out + [best[i] for i in sorted(best)]

    def _single(self, coded: np.ndarray) -> list[tuple]:
        """Items of one word, which make no pair."""
        if not self.single:
            return []
        there, first = np.unique(coded, return_index=True)
        at = {w: k for w, k in zip(there.tolist(), first.tolist()) if w in self.single}
        return [(self.ids[i], at[w], 1.0, 1.0, 1.0) for w in sorted(at) for i in self.single[w]]


def shingled(coded: np.ndarray, n: int = 0) -> tuple[int, np.ndarray]:
    """(n, sorted distinct hashes of the shingles of n words): SHINGLE words, or all there are."""
    n = n or min(SHINGLE, len(coded))
    if not n or len(coded) < n:
        return n, np.empty(0, np.uint64)
    h = np.zeros(len(coded) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ (coded[k : k + len(h)].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return n, np.unique(h)


def share(part: tuple[int, np.ndarray], passage: np.ndarray) -> float:
    """Share of the shingles of a part that the passage holds; nothing to hold counts as held."""
    n, own = part
    return float(np.isin(own, shingled(passage, n)[1], assume_unique=True).mean()) if len(own) else 1.0


@model
def _index(items: tuple) -> Index:
    return Index(list(items))


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[tuple, bool]]:
    """The items in blocks of about BLOCK_CHARS characters at most (one longer item is a block), each brought here when it is asked for; and whether there are several."""
    kind = "long" if isinstance(benchmark.schema[item_col].dataType, IntegralType) else "string"
    own = benchmark.select(F.col(item_col).cast(kind).alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (BLOCK_CHARS // 2)))
    blocks = own.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    for k in range(n):
        yield tuple((r.item, r.text) for r in blocks.where(F.col("block") == k).drop("block").distinct().collect()), n > 1


def leaked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each row of docs and item that leaks into it: id_col, item_id, word, score, question, answer."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    item, arrow = ("long", pa.int64()) if isinstance(benchmark.schema[item_col].dataType, IntegralType) else ("string", pa.string())
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    out = None
    for items, several in item_blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            index = _index(shared.value)
            for batch in slices(batches):
                rows = [(k, *hit) for k, t in enumerate(batch.column(1).to_pylist()) for hit in index.leaks(t)]
                columns = list(zip(*rows)) or [[]] * 6
                kinds = [arrow, pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns[1:], kinds))], names=["id", "item_id", "word", "score", "question", "answer"])

        part = source.mapInArrow(leanly(run, _index), f"id {kind}, item_id {item}, word long, score double, question double, answer double")
        if several:  # so that no more than one block is held at a time
            part = written(part, "leaks")
            shared.destroy()
        out = part if out is None else out.union(part)
    return out.withColumnRenamed("id", id_col)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, into which no item leaks; no shuffle."""
    out, place = docs, docs.columns.index(text_col)
    for items, several in item_blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            index = _index(shared.value)
            for batch in slices(batches):
                yield batch.filter(pa.array([not index.leaks(t) for t in batch.column(place).to_pylist()], pa.bool_()))

        out = out.mapInArrow(leanly(run, _index), docs.schema)
        if several:
            out = written(out, "decontaminated")
            shared.destroy()
    return out
