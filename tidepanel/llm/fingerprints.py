"""MinHash fingerprints of documents.

A document's set is its distinct shingles of WIDTH code points (a shorter text is one shingle). Each of PERMUTATIONS universal
hash functions x -> a x + b on 32-bit numbers, a odd, is a permutation; a fingerprint holds the low 16 bits of the smallest value under each,
found for many texts at a time in numpy. The share of equal places of two fingerprints estimates the Jaccard similarity of the sets.

fingerprinted() compares each document with an edited text and with its neighbour by id: documents are sorted by ranges of ids,
each task takes its rows in order and compares neighbours as they come, and the few pairs across tasks are made afterwards. matched()
joins the bands of all fingerprints (four places each) in Spark and confirms pairs on their full sets.

Defined results: a null text is an empty one; empty texts have a fingerprint of their own and equal each other; rows that share an
id are neighbours in any order; rows without an id come first; one row is its own neighbour; an empty table gives no rows; very long texts
are read whole; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import neardup
from .common import leanly, slices, written

WIDTH, PERMUTATIONS, BAND = 8, 128, 4
#: Shingles hashed at a time, code points of texts handled together, and bytes of text that a range of ids holds.
CHUNK, AT_ONCE, RANGE = 1 << 15, 1 << 20, 64 << 20
_random = np.random.default_rng(74093)
_A = (_random.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _random.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_WEIGHTS = _random.integers(1, 1 << 63, WIDTH + 1, dtype=np.uint64) | np.uint64(1)
_EMPTY = np.uint32(0xFFFFFFFF)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of all windows of WIDTH code points; a shorter, non-empty text is one window."""
    n = len(codes)
    if n < WIDTH:
        codes, n = np.r_[codes, np.zeros(WIDTH - n, np.uint32)], n
        start = np.array([n * int(_WEIGHTS[WIDTH]) % (1 << 64)], np.uint64)
    else:
        start = np.zeros(n - WIDTH + 1, np.uint64)
    for i in range(WIDTH):
        start += codes[i : i + len(start)] * _WEIGHTS[i]
    return _mixed(start)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _least(pieces: list[np.ndarray]) -> np.ndarray:
    """For each list of code points the smallest value under each permutation; none has windows of less than WIDTH unless it is a whole short text."""
    out = np.full((len(pieces), PERMUTATIONS), _EMPTY, np.uint32)
    parts: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if parts:
            x = np.concatenate([h for _, h in parts])
            starts = np.cumsum([0, *(len(h) for _, h in parts[:-1])])
            own, made = np.array([i for i, _ in parts]), np.empty((len(parts), PERMUTATIONS), np.uint32)
            for p in range(PERMUTATIONS):
                made[:, p] = np.minimum.reduceat(x * _A[p] + _B[p], starts)
            np.minimum.at(out, own, made)
            parts.clear()
            size = 0

    for i, codes in enumerate(pieces):
        if not len(codes):
            continue
        for at in range(0, max(1, len(codes) - WIDTH + 1), CHUNK):
            h = (_hashes(codes[at : at + CHUNK + WIDTH - 1]) >> np.uint64(32)).astype(np.uint32)
            if size + len(h) > CHUNK:
                flush()
            parts.append((i, h))
            size += len(h)
    flush()
    return out


def _packed(least: np.ndarray) -> np.ndarray:
    return least.astype(np.uint16)


def signatures(texts: list[str]) -> np.ndarray:
    """A row of PERMUTATIONS 16-bit numbers for each text."""
    return _packed(_least([_codes(t) for t in texts]))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal places, row by row."""
    return (a == b).mean(1)


def edited(text: str, after: str) -> str:
    """The text with the first code points of the next one in place of its last quarter."""
    part = len(text) // 4
    return text[: len(text) - part] + after[:part]


def _both(texts: list[str], after: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Signatures of the texts, the edited texts, and signatures of those; windows that both have are hashed once."""
    new = [edited(t, a) for t, a in zip(texts, after)]
    shared, old_ends, new_ends, none = [], [], [], np.empty(0, np.uint32)
    for t, e in zip(texts, new):
        old, now = _codes(t), _codes(e)
        kept = len(old) - len(old) // 4
        from_ = max(0, kept - WIDTH + 1)
        shared.append(old[:kept] if kept >= WIDTH else none)
        old_ends.append(old[from_:] if len(old) < WIDTH or len(old) - from_ >= WIDTH else none)
        new_ends.append(now if len(now) < WIDTH else now[from_:] if len(now) - from_ >= WIDTH else none)
    least = _least(shared + old_ends + new_ends)
    n = len(texts)
    return _packed(np.minimum(least[:n], least[n : 2 * n])), new, _packed(np.minimum(least[:n], least[2 * n :]))


_FIELDS = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _rows(ids: pa.Array, texts: list[str], own: np.ndarray, new: list[str], changed: np.ndarray, after: np.ndarray) -> list[pa.Array]:
    return [
        ids,
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in new], pa.string()),
        pa.array([x.tobytes() for x in own], pa.binary()),
        pa.array([x.tobytes() for x in changed], pa.binary()),
        pa.array(likeness(own, changed)),
        pa.array(likeness(own, after)),
    ]


def _groups(texts: list[str]):
    """Slices of the texts, of AT_ONCE code points or a single text each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > AT_ONCE:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _in_order(docs: DataFrame, kind: str) -> DataFrame:
    """A row per document of sorted partitions but the last of each; that comes with its text and the first text of its partition."""
    names = ["id", *(f.split()[0] for f in _FIELDS.split(", ")), "part", "head", "tail"]

    def run(batches):
        part = head = last = None
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            if last is None:
                part, head = batch.column(2)[0].as_py(), texts[0]
            else:
                ids, texts = pa.concat_arrays([last[0], ids]), [last[1], *texts]
            last = (ids.slice(len(ids) - 1), texts[-1])
            now, after = texts[:-1], texts[1:]
            for at in _groups(now):
                own, new, changed = _both(now[at], after[at])
                follow = signatures([after[at][-1]])
                columns = _rows(ids.slice(at.start, at.stop - at.start), now[at], own, new, changed, np.vstack([own[1:], follow]))
                n = at.stop - at.start
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=names)
        if last is not None:
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([last[0], *(pa.nulls(1, k) for k in kinds), pa.array([part], pa.int32()), pa.array([head]), pa.array([last[1]])], names=names)

    return docs.mapInArrow(leanly(run), f"id {kind}, {_FIELDS}, part int, head string, tail string")


def _paired(pairs: DataFrame, kind: str) -> DataFrame:
    """Rows of (id, text, after)."""
    names = ["id", *(f.split()[0] for f in _FIELDS.split(", "))]

    def run(batches):
        for batch in slices(batches, 16):
            texts, after = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            if texts:
                own, new, changed = _both(texts, after)
                yield pa.RecordBatch.from_arrays(_rows(batch.column(0), texts, own, new, changed, signatures(after)), names=names)

    return pairs.mapInArrow(leanly(run), f"id {kind}, {_FIELDS}")


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint (binary), near_edited, near_next."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    size = base.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("size")).first()["size"]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE))
    tie = F.xxhash64("text")
    sorted_ = base.repartitionByRange(ranges, "id", tie).sortWithinPartitions("id", tie)
    made = written(_in_order(sorted_.select("id", "text", F.spark_partition_id().alias("part")), kind), "fingerprints")
    ends = made.where("part is not null").select("id", "part", "head", "tail")
    parts = sorted(r["part"] for r in ends.select("part").collect())  # a number a task
    follows = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]])), "part int, following int")
    heads = ends.select(F.col("part").alias("following"), F.col("head").alias("after"))
    across = ends.join(F.broadcast(follows), "part").join(heads, "following").select("id", F.col("tail").alias("text"), "after")
    columns = ["id", *(f.split()[0] for f in _FIELDS.split(", "))]
    return made.where("part is null").select(*columns).union(_paired(across, kind).select(*columns)).withColumnRenamed("id", id_col)


def _sets(text: bytes | None, _: int) -> np.ndarray:
    codes = _codes((text or b"").decode("utf-8", "surrogatepass"))
    return np.unique(_hashes(codes)) if len(codes) else np.empty(0, np.uint64)


def _bands(sets: list[np.ndarray]) -> np.ndarray:
    """The fingerprints of non-empty sets as 64-bit keys, BAND places each."""
    out = np.empty((len(sets), PERMUTATIONS), np.uint32)
    for i, s in enumerate(sets):
        x = (s >> np.uint64(32)).astype(np.uint32)
        for p in range(PERMUTATIONS):
            out[i, p] = (x * _A[p] + _B[p]).min()
    return _packed(out).view(np.uint64)


def matched(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id: the size of a document's set and the smallest id of those that it is linked with, over others too.

    Bands of fingerprints are joined in Spark; pairs that share one and are not yet connected are confirmed by the Jaccard
    similarity of their full sets. Texts with equal sets are compared once, and no bucket's pairs are listed.
    Two sets of similarity 0.8 share no band with a chance of (1 - 0.8^4)^32 < 5e-8.
    """
    return neardup.near_duplicates(docs, WIDTH, similarity, id_col, text_col, _sets, _bands)
