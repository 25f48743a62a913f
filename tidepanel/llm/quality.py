"""Quality by importance resampling: hashed n-gram models of the target and of the raw texts, sampled by Gumbel top-k.

Words and runs of signs of a text, lower-cased, and their pairs are hashed to SLOTS slots. The raw model counts them
over all documents, the target model over labelled documents of good quality (at most about SAMPLE of them). A text's
log weight is the log of the ratio of its probabilities under the two models: the sum over its n-grams of their log ratios. (With
per_gram it is the mean times per_gram, for a sample in which length decides nothing.)
Sampling without replacement in proportion to the weights keeps the k largest keys 'log weight + Gumbel noise';
the noise is a hash of id and seed, so that a retried task draws the same. The k-th key is found by counting in ever
narrower intervals; neither a sort of all keys nor a limit meets in one task.

Defined results: null and empty texts have weight 0 (no evidence); without labels of good quality all weights are 0;
rows that repeat an id share its noise, rows without an id have their own, by their place in the scan; where the k-th key belongs to several rows,
smaller ids stay first, and of rows with one id those that stand first in the table of weights; very long texts are read whole; an empty table
gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cache, id_bitmap, leanly, may_hold, slices, written

SLOTS, SAMPLE, SMOOTH = 10_000, 20_000, 1.0
_TOKEN = re.compile(r"\w+|[^\w\s]+")


_words = Cache(lambda word: xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")))


def slots(text: str | None) -> np.ndarray:
    """Slot of each word and of each pair of neighbours."""
    h = np.array([_words[w] for w in _TOKEN.findall((text or "").lower())], np.uint64)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xD6E8FEB86659FD93)
    return (np.concatenate([h, pairs >> np.uint64(16)]) % np.uint64(SLOTS)).astype(np.int64)


def _counted(texts: DataFrame) -> np.ndarray:
    """How often each slot occurs over all texts: each task sends SLOTS sums per batch at most."""

    def run(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in slices(batches):
            total += np.bincount(np.concatenate([slots(t) for t in batch.column(0).to_pylist()]), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    out = np.zeros(SLOTS)
    for r in texts.mapInArrow(leanly(run), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # at most SLOTS rows
        out[r.slot] = r.n
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """(log ratio of each slot, share of labelled documents that are good)."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    own = labels.where(f"{label_col} in (0, 1) and {id_col} is not null").groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).alias("y"))
    size = own.agg(F.count("*").alias("n"), F.sum("y").alias("good")).first()
    good = size.good or 0
    if not good:
        return np.zeros(SLOTS), 1.0
    part = int(1_000_000 * min(1.0, sample / good))
    chosen = written(own.where((F.col("y") == 1) & (F.pmod(F.xxhash64("id", F.lit(21)), F.lit(1_000_000)) < part)).select("id"), "target")
    target = _counted(may_hold(texts, "id", id_bitmap(chosen, "id")).join(chosen, "id", "left_semi").select("text")) + SMOOTH
    raw = _counted(texts.select("text")) + SMOOTH
    return np.log(target / target.sum()) - np.log(raw / raw.sum()), good / size.n


def weighted(docs: DataFrame, ratio: np.ndarray, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", per_gram: float | None = None) -> DataFrame:
    """id_col, log_weight and key (with noise) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for batch in slices(batches):
            own = [shared.value[slots(t)] for t in batch.column(1).to_pylist()]
            w = [float(x.sum() if per_gram is None else x.mean() * per_gram) if len(x) else 0.0 for x in own]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(w, pa.float64())], names=["id", "log_weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(leanly(run), f"id {kind}, log_weight double")
    drawn = F.when(F.col("id").isNotNull(), F.xxhash64("id", F.lit(seed))).otherwise(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed), F.lit("place")))
    u = (F.pmod(drawn, F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return out.withColumn("key", F.col("log_weight") - F.log(-F.log(u))).withColumnRenamed("id", id_col)


def _edge(rows: DataFrame, k: int, key: str, enough: int) -> tuple[float, int]:
    """The k-th largest key of 0 < k < n, and how many rows are beyond it: by counts in ever narrower intervals."""
    ends = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, hi, above = ends.lo, ends.hi, 0  # the k-th key is in [lo, hi], above rows are beyond hi
    while True:
        step = (hi - lo) / 1024
        if not step or lo + step <= lo:
            return lo, above
        place = F.least(F.lit(1023), F.floor((F.col(key) - lo) / step).cast("int"))
        counts = rows.where(F.col(key).between(lo, hi)).groupBy(place.alias("at")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).orderBy(F.desc("at")).collect()
        for r in counts:
            if above + r.n >= k:
                break
            above += r.n
        lo, hi = r.lo, r.hi
        if r.n <= enough:
            keys = sorted((x[0] for x in rows.where(F.col(key).between(lo, hi)).select(key).collect()), reverse=True)
            return keys[k - above - 1], above + sum(x > keys[k - above - 1] for x in keys)


def top_k(rows: DataFrame, k: int, key: str = "key", tie: str = "doc_id", enough: int = 4096) -> DataFrame:
    """The k rows of a written table with the largest keys (finite numbers); ties by the smaller tie column, nulls last."""
    n = rows.count()
    if k >= n or k <= 0:
        return rows if k > 0 else rows.where("false")
    edge, above = _edge(rows, k, key, enough)
    sure, level = rows.where(F.col(key) > edge), written(rows.where(F.col(key) == edge).withColumn("_at", F.monotonically_increasing_id()), "ties")
    missing, taken, last = k - above, 0, None
    for last in level.groupBy(tie).agg(F.count("*").alias("n")).orderBy(F.asc_nulls_last(tie)).limit(missing).collect():  # ids of one key: few, as keys are draws by id
        if taken + last.n >= missing:
            break
        taken += last.n
    before = F.col(tie).isNotNull() if last[tie] is None else F.col(tie) < F.lit(last[tie])
    own = level.where(F.col(tie).eqNullSafe(F.lit(last[tie])))
    if taken + last.n > missing:  # some of the rows with one id: those that stand first
        place, _ = _edge(own.withColumn("_back", -F.col("_at").cast("double")), missing - taken, "_back", enough)
        own = own.where(F.col("_at") <= -place)
    return sure.union(level.where(before).drop("_at")).union(own.drop("_at"))


def resampled(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", per_gram: float | None = None) -> DataFrame:
    """A sample of share of the rows of docs (as many as labels call good, by default): id_col, log_weight, key."""
    ratio, good = fit(docs, labels, id_col, text_col)
    rows = written(weighted(docs, ratio, seed, id_col, text_col, per_gram), "weights")
    return top_k(rows, round((good if share is None else share) * rows.count()), tie=id_col)
