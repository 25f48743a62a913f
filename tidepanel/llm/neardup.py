"""MinHash near-duplicate detection on HyperMinHash sketches.

A document's set is its distinct k-word shingles. Each of ROWS hashings deals the shingles to BUCKETS buckets; a
bucket keeps its smallest hash, compressed to the count of its leading zeros and MANTISSA bits after them (16 bits).
The registers of one hashing are one band, and one 64-bit key. Documents that share a band key are candidates; the
share of equal registers, less the collisions that compression makes by chance, estimates their similarity; pairs
whose estimate may reach the threshold are confirmed on their full sets.

Texts with equal sets form one class; only classes are compared. Within a band bucket no list of all pairs is made:
first every class is compared with the bucket's smallest (a star); then each with the
most similar classes of other components; at last all pairs that are still apart and may reach the threshold. So every pair that shares a band key is either confirmed,
refused, estimated too far, or already connected: components are those of all such pairs. Two sets of similarity
0.8 share no band key with a chance of (1 - 0.8^4)^32 < 5e-8.

A class goes by the smallest id of its rows, which ids that are unique make unique.

Defined results: null and blank texts have an empty set and stay alone; rows without an id are never compared: they
take the component of the class of their text, or null if no row with an id has that set; repeated rows get equal
results; rows that share an id but not a text count as linked; very long texts are compared by their full sets; an empty table gives
no rows; other columns, whatever their names, are ignored by near_duplicates() and kept by deduplicated().
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Cache, id_bitmap, leanly, may_hold, slices, written

ROWS, BUCKETS, MANTISSA = 32, 4, 10
#: Share of a register's values that agree by chance for sets of like size, times 2^MANTISSA (Yu and Weber, 2017).
CHANCE = 0.169919487159739
#: Standard deviations below the threshold at which an estimate still counts as possible.
SLACK = 5.0
CHUNK = 1 << 15
BLOCK = 512
OFFERED, CELL, CELL_BYTES = 4, 4096, 16 << 20
_SEEDS = np.random.default_rng(20177).integers(1, 1 << 63, 2 * ROWS + 64, dtype=np.uint64) | np.uint64(1)


_words = Cache(xxhash.xxh3_64_intdigest)  # word to 64-bit hash


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a UTF-8 text; words are split at ASCII white space."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([_words[w] for w in words], np.uint64)
    n = max(1, len(h) - k + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(min(k, len(h))):
        mixed = _mix(mixed + h[i : i + n] * _SEEDS[2 * ROWS + i])
    return np.unique(mixed)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ROWS 64-bit keys per non-empty set: BUCKETS registers of 16 bits each."""
    out = np.empty((len(sets), ROWS), np.uint64)
    start = 0
    while start < len(sets):
        stop, size = start, 0
        while stop < len(sets) and (stop == start or size + len(sets[stop]) <= CHUNK):
            size += len(sets[stop])
            stop += 1
        all_ = np.concatenate(sets[start:stop])
        at = np.cumsum([0, *(len(s) for s in sets[start : stop - 1])])
        for row in range(ROWS):
            h = _mix((all_ + _SEEDS[2 * row]) * _SEEDS[2 * row + 1])
            bucket, value = h & np.uint64(BUCKETS - 1), h >> np.uint64(2)
            key = np.zeros(stop - start, np.uint64)
            for b in range(BUCKETS):
                least = np.minimum.reduceat(np.where(bucket == b, value, np.uint64(1 << 62)), at)
                key = (key << np.uint64(16)) | _register(least)
            out[start:stop, row] = key
        start = stop
    return out


def _register(least: np.ndarray) -> np.ndarray:
    """Leading zeros of 62 bits (6 bits) and the MANTISSA bits after the leading one; an empty bucket is all ones."""
    top = np.frexp(least.astype(np.float64))[1].astype(np.int64)  # bits up to the leading one
    over = (least >> np.minimum(np.maximum(top - 1, 0), 63).astype(np.uint64)) == 0  # rounding went up to the next power
    top = np.where(over & (least > 0), top - 1, top)
    shift = top - 1 - MANTISSA
    mantissa = np.where(shift >= 0, least >> np.maximum(shift, 0).astype(np.uint64), least << np.minimum(np.maximum(-shift, 0), 63).astype(np.uint64))
    made = ((62 - top).astype(np.uint64) << np.uint64(MANTISSA)) | (mantissa & np.uint64((1 << MANTISSA) - 1))
    return np.where(least >= np.uint64(1 << 62), np.uint64(0xFFFF), made)


def estimated(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of sets from their band keys, row by row, corrected for chance collisions of compressed registers."""
    x = (a ^ b).view(np.uint16)
    empty = (a & b).view(np.uint16) == 0xFFFF
    used = np.maximum(1, (~empty).reshape(len(x), -1).sum(1))
    equal = ((x == 0) & ~empty).reshape(len(x), -1).sum(1)
    c = CHANCE / (1 << MANTISSA)
    return (equal / used - c) / (1 - c)


def _unpacked(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64).reshape(-1, ROWS)


def least_estimate(similarity: float, used: int = ROWS * BUCKETS) -> float:
    return similarity - SLACK * (similarity * (1 - similarity) / used) ** 0.5


def sketched(docs: DataFrame, k: int, shingles: Callable = shingle_hashes, bands: Callable = band_keys) -> DataFrame:
    """row id, id, set size, set name (128 bits) and band keys of each document; empty sets have no keys."""

    def run(batches):
        for batch in slices(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            sets = [shingles(t, k) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                for i, row in zip(full, bands([sets[i] for i in full])):
                    keys[i] = row.tobytes()
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array(keys, pa.binary())],
                names=["id", "n", "name", "keys"],
            )

    return docs.select("id", "text").mapInArrow(leanly(run), "id long, n long, name binary, keys binary")


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int, shingles: Callable = shingle_hashes) -> DataFrame:
    """Full sets of the classes in wanted (node), and the low 16 bits of each; of docs (id, text) only their texts are shuffled."""
    some = may_hold(docs, "id", id_bitmap(wanted, "node"))
    texts = some.join(wanted, F.col("id") == F.col("node")).select("node", "text")

    def run(batches):
        for batch in slices(batches):
            sets = [shingles(t, k) for t in batch.column(1).to_pylist()]
            low = [s.astype(np.uint16).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(low, pa.binary())], names=["node", "set", "low"])

    own = texts.mapInArrow(leanly(run), "node long, set array<long>, low binary")
    return own.groupBy("node").agg(F.min(F.struct("set", "low")).alias("x")).select("node", "x.set", "x.low")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity; in hundredths, with whole numbers."""
    a, b = sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    both = pairs.join(b, "b").join(a, "a").select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("n"))
    return both.where(F.col("n") * 100 >= round(similarity * 100) * (F.col("na") + F.col("nb") - F.col("n"))).select("a", "b")


def _possible(pairs: DataFrame, keys: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose estimate may reach the similarity."""
    least = least_estimate(similarity)

    def run(batches):
        for batch in slices(batches):
            if batch.num_rows:
                x, y = (_unpacked(batch.column(i).to_pylist()) for i in (2, 3))
                good = estimated(x, y) >= least
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))

    a, b = keys.select(F.col("node").alias("a"), F.col("keys").alias("ka")), keys.select(F.col("node").alias("b"), F.col("keys").alias("kb"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "ka", "kb").mapInArrow(leanly(run), "a long, b long")


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, label): the smallest node of each component, by labels and pointer jumping; edges has columns a, b."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    for _ in range(most):
        far = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("seen"))
        near = labels.join(far, labels.node == far.a, "left").select("node", "label", F.least("label", "seen").alias("low"))
        ends = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        new = written(near.join(ends, "low", "left").select("node", F.least("low", "lower").alias("label"), (F.least("low", "lower") < F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def _apart(members: DataFrame, cells: int, similarity: float, most: int | None) -> DataFrame:
    """(a, b, near): pairs of classes of one band bucket that are in different components and may be similar.

    members: bucket, band, node, comp, keys, low, block, lo, hi. Buckets are cut into blocks of BLOCK classes, and each
    pair of blocks is compared on its own, so no task holds a whole bucket. A pair counts in the first band that it
    shares. Pairs whose estimate may reach the similarity are counted once more on the low 16 bits of all their
    shingles: hashes that meet there by chance only add to what two sets share, so no similar pair is refused.
    With most, each class of a block offers only its most similar ones.
    """
    least, hundredths = least_estimate(similarity), round(similarity * 100)

    def compared(keys, comp, low, band, left, right, same):
        sizes = np.array([len(x) for x in low])
        held = np.zeros(1 << 16, bool)
        for i in left:
            js = right[right > i] if same else right
            js = js[comp[js] != comp[i]]
            if len(js):
                js = js[(keys[js] == keys[i]).argmax(1) == band]
            if len(js):
                js = js[estimated(np.broadcast_to(keys[i], (len(js), ROWS)).copy(), keys[js]) >= least]
            if not len(js):
                continue
            held[low[i]] = True
            both = np.minimum(sizes[i], np.add.reduceat(held[np.concatenate([low[j] for j in js])], np.cumsum([0, *sizes[js[:-1]]]), dtype=np.int64))
            held[low[i]] = False
            all_ = sizes[i] + sizes[js] - both
            js, near = js[100 * both >= hundredths * all_], (both / all_)[100 * both >= hundredths * all_]
            if most and len(js) > most:
                top = np.argsort(-near, kind="stable")[:most]
                js, near = js[top], near[top]
            for j, x in zip(js, near):
                yield i, j, x

    def run(pdf):
        import pandas as pd

        keys, node = _unpacked(pdf["keys"].tolist()), pdf["node"].to_numpy()
        low = [np.frombuffer(x, np.uint16) for x in pdf["low"]]
        comp, band, lo, hi, own = (pdf[c].to_numpy() for c in ("comp", "band", "lo", "hi", "block"))
        order = np.lexsort((node, hi, lo, pdf["bucket"].to_numpy()))
        group = np.stack([pdf["bucket"].to_numpy(), lo, hi])[:, order]
        starts = np.flatnonzero(np.r_[True, (group[:, 1:] != group[:, :-1]).any(0)]).tolist()
        out = []
        for s, e in zip(starts, [*starts[1:], len(order)]):
            at = order[s:e]
            f, o = at[0], own[at]
            found = compared(keys[at], comp[at], [low[x] for x in at], band[f], np.flatnonzero(o == lo[f]), np.flatnonzero(o == hi[f]), lo[f] == hi[f])
            out += [(min(node[at[i]], node[at[j]]), max(node[at[i]], node[at[j]]), x) for i, j, x in found]
        return pd.DataFrame(out, columns=["a", "b", "near"])

    return members.groupBy(F.pmod(F.xxhash64("bucket", "lo", "hi"), F.lit(cells))).applyInPandas(run, "a long, b long, near double")


def _nearest(offers: DataFrame) -> DataFrame:
    """Each class's most similar offer, from either end of it."""
    ends = offers.select("a", "b", "near", F.explode(F.array("a", "b")).alias("node"))
    return ends.groupBy("node").agg(F.max(F.struct("near", "a", "b")).alias("x")).select("x.a", "x.b").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", shingles: Callable = shingle_hashes, bands: Callable = band_keys) -> DataFrame:
    """(id_col, n_shingles, component_id): for each row the size of its set and the smallest id of its component.

    Other sets and band keys may be given: shingles(text, k) makes sorted distinct 64-bit hashes, bands(sets) ROWS keys of BUCKETS 16-bit registers each.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = written(sketched(base, k, shingles, bands), "sketches")
    classes = written(rows.where("n > 0 and id is not null").groupBy("name", "keys").agg(F.min("id").alias("node"), F.max("n").alias("n")), "classes")
    banded = classes.select("node", "n", "keys", F.explode(F.sequence(F.lit(0), F.lit(ROWS - 1))).alias("band"))
    banded = banded.select("node", "n", "band", F.xxhash64("band", F.expr("substring(keys, 8 * band + 1, 8)")).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("hub")).where("size > 1")
    banded = written(banded.join(shared, "bucket"), "banded")
    keys = classes.select("node", "keys")
    sets = written(_sets_of(base, banded.select("node").distinct(), k, shingles), "sets")
    star = banded.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    tried = pairs = written(_possible(star, keys, similarity), "pairs")
    links = written(_confirmed(pairs, sets, similarity), "links")
    labels = components(links)
    for most in (OFFERED, None):
        offers = _apart(*_divided(banded, labels, keys, sets), similarity, most).join(tried, ["a", "b"], "left_anti")
        pairs = written(_nearest(offers) if most else offers.select("a", "b"), "pairs")
        found = written(_confirmed(pairs, sets, similarity), "links")
        if not found.isEmpty():
            links = links.union(found)
            labels = components(links)
        tried = tried.union(pairs)
    return _result(rows, classes, labels, id_col, docs.schema[id_col].dataType)


def _divided(banded: DataFrame, labels: DataFrame, keys: DataFrame, sets: DataFrame) -> tuple[DataFrame, int]:
    """Members of the buckets that hold more than one component, for each pair of blocks, and a number of cells for them."""
    at = banded.join(labels, "node", "left").select("bucket", "band", "node", "n", "size", F.coalesce("label", "node").alias("comp"))
    blocks = F.ceil(F.max("size") / BLOCK).cast("int")
    mixed = at.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("rows"), F.sum("n").alias("held"), blocks.alias("blocks")).where("c0 <> c1")
    mixed = written(mixed.select("bucket", "rows", "held", "blocks"), "mixed")
    total = mixed.agg(F.coalesce(F.sum(F.expr("rows * blocks")), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.expr("2 * held * blocks")), F.lit(0)).alias("bytes")).first()
    cells = max(1, total.rows // CELL, total.bytes // CELL_BYTES)
    own = at.select("bucket", "band", "node", "comp").join(mixed.drop("rows", "held"), "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    own = own.join(keys, "node").join(sets.select("node", "low"), "node")
    pairs = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "blocks"), cells


def _result(rows: DataFrame, classes: DataFrame, labels: DataFrame, id_col: str, kind) -> DataFrame:
    own = classes.select("name", "node").join(labels, "node", "left").select(F.col("name").alias("of"), F.coalesce("label", "node").alias("label"))
    full = rows.where("n > 0").join(own, F.col("name") == F.col("of"), "left").select("id", "n", F.col("label").alias("component"))
    out = full.union(rows.where("n = 0").select("id", "n", F.col("id").alias("component")))
    return out.select(F.col("id").cast(kind).alias(id_col), F.col("n").alias("n_shingles"), F.col("component").cast(kind).alias("component_id"))


def _numbered(keyed: DataFrame) -> DataFrame:
    """keyed with the numbers that follow the largest _id in place of nulls; such rows are written, so that numbers stay."""
    lost = keyed.where("_id is null").drop("_id")
    if lost.isEmpty():
        return keyed
    lost = written(lost.withColumn("_at", F.monotonically_increasing_id()), "lost").withColumn("_part", F.shiftright("_at", 33))
    last, starts = keyed.agg(F.max("_id")).first()[0], []
    start = 0 if last is None else last + 1
    for r in sorted(lost.groupBy("_part").count().collect()):  # one row a task
        starts.append((r["_part"], start))
        start += r["count"]
    if start > 1 << 63:
        raise ValueError("no numbers are left beyond the largest id")
    own = lost.join(F.broadcast(keyed.sparkSession.createDataFrame(starts, "_part long, _start long")), "_part")
    numbers = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return keyed.where("_id is not null").unionByName(own.select("_row", numbers.alias("_id"), "_text"))


def deduplicated(docs: DataFrame, k: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, less all but one of each component.

    The row of the component's smallest id stays, the one with the smallest text if rows share that id. Rows without an
    id count as the last ones, each with an id of its own: one of them stays if its component has no row with an id.
    Texts are shuffled only where a row may go: a filter of fixed size over the ids of such rows lets all others pass.
    """
    columns = docs.columns
    keyed = _numbered(docs.select(F.struct(*[docs[c] for c in columns]).alias("_row"), docs[id_col].cast("long").alias("_id"), docs[text_col].alias("_text")))
    found = near_duplicates(keyed, k, similarity, "_id", "_text")
    going = found.groupBy("_id").agg(F.min(F.col("_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n")).where("not stays or n > 1")
    going = written(going.select("_id", "stays"), "going")
    bits = 1 << 23
    keyed = keyed.drop("_text")
    slot = F.pmod(F.xxhash64("_id"), F.lit(bits))
    marked = keyed.withColumn("_word", F.floor(slot / 64).cast("int")).join(F.broadcast(id_bitmap(going, "_id", bits)), "_word", "left")
    hit = F.coalesce(F.expr(f"shiftright(_mask, int(pmod(xxhash64(_id), {bits}) % 64)) & 1 = 1"), F.lit(False))
    sure = marked.where(~hit).select("_row")
    asked = marked.where(hit).select("_row", "_id").join(going, "_id", "left")
    order = Window.partitionBy("_id").orderBy(F.col("_row")[text_col].asc_nulls_first(), *[F.col("_row")[c].asc_nulls_first() for c in columns if c != text_col])
    once = asked.where("stays is null or stays").withColumn("_n", F.row_number().over(order)).where("stays is null or _n = 1")
    return sure.union(once.select("_row")).select(*[F.col("_row")[c].alias(c) for c in columns])
