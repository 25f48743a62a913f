"""Helpers that several operators share: shared storage, written tables, bounded caches."""

from __future__ import annotations

import ctypes
import uuid
import weakref
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.stored import shared_dir, stored

written = stored


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidepanel/{name}-{uuid.uuid4().hex}"


def lean_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Fewer rows in an Arrow batch than Spark's default, unless the session sets another number: rows of texts are long, and a task's JVM and worker hold whole batches."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lean_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bitmap(ids: DataFrame, column: str, bits: int = 1 << 23) -> DataFrame:
    """A filter of fixed size over the ids: at most bits/64 rows (word, mask), whatever the number of ids."""
    slots = ids.select(F.pmod(F.xxhash64(column), F.lit(bits)).alias("_slot"))
    return slots.groupBy(F.expr("int(_slot div 64)").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, int(_slot % 64))")).alias("_mask"))


def may_hold(df: DataFrame, column: str, bitmap: DataFrame, bits: int = 1 << 23) -> DataFrame:
    """Rows of df whose id may be among those of the bitmap; a bounded broadcast (bits/64 rows), no shuffle of df."""
    keyed = df.withColumn("_slot", F.pmod(F.xxhash64(column), F.lit(bits))).withColumn("_word", F.expr("int(_slot div 64)")).withColumn("_at", F.expr("int(_slot % 64)"))
    hit = keyed.join(F.broadcast(bitmap), "_word").where(F.expr("shiftright(_mask, _at) & 1 = 1"))
    return hit.drop("_slot", "_word", "_at", "_mask")


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows, which bounds what a worker unpacks at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Bytes that one cache may hold, what an entry takes besides its key, and the longest key that is kept.
CACHE_BYTES, ENTRY, LONG_KEY = 24 << 20, 200, 64
_caches: weakref.WeakSet[Cache] = weakref.WeakSet()


class Cache(dict):
    """Values by word that make() computes when they are asked for; emptied when it holds more than most bytes.

    Values of long words are computed anew each time, so that junk without spaces takes no room.
    """

    def __init__(self, make: Callable, most: int = CACHE_BYTES) -> None:
        self.make, self.most, self.room = make, most, most
        _caches.add(self)

    __hash__ = object.__hash__

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= LONG_KEY:
            self.room -= ENTRY + len(word)
            if self.room < 0:
                self.clear()
            self[word] = value
        return value

    def clear(self) -> None:
        super().clear()
        self.room = self.most


_models: dict[str, Callable] = {}


def model(make: Callable) -> Callable:
    """make, whose last result a worker keeps until a task of another operator begins."""
    own = _models[f"{make.__module__}.{make.__qualname__}"] = lru_cache(1)(make)
    return own


def give_back() -> None:
    """Empty this worker's caches and return free memory to the machine."""
    for c in _caches:
        c.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_last = ""


def begin(title: str) -> None:
    """Empty the caches if the last task was of another function."""
    global _last
    if _last != title:
        give_back()
        _last = title


def leanly(run: Callable, *models: Callable, keep: bool = False) -> Callable:
    """run, for mapInArrow, in workers that hold no more than the models named and the caches of the task at hand; with keep, those
    of the tasks before it too (no more bytes, as caches are bounded), until a task of another function begins."""
    names = {k for k, m in _models.items() if m in models}
    title = f"{run.__module__}.{run.__qualname__}"

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, m in _models.items():
            if k not in names:
                m.cache_clear()
        begin(title)
        try:
            yield from run(batches)
        finally:
            if not keep:
                give_back()

    return own
