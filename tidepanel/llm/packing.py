"""Best-fit packing of tokenised documents into sequences of a fixed length, by hierarchical residual packing.

A document is its token ids and one separator. Longer ones are cut into pieces of the full length; only they are cut.
Groups of about ITEMS pieces are packed on their own by best fit, longest first; bins with at most SLACK places left are
final. All other bins become items of the next round, in which neighbouring groups merge: up to FAN of them, but into no
fewer groups than hold ITEMS bins each, so that none grows with the input. Rounds go on until one group is left, or
until a round puts fewer than one in a hundred bins into another (where most bins are over half full, say; gain=0 never ends so); its bins are final.

Defined results: a null text is an empty one, whose only id is the separator; rows are pieces of their own even if
they repeat; a null id is kept; a very long text gives as many pieces as it needs; other columns, whatever their names, are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import leanly, slices, written

SLACK, FAN, ITEMS, GAIN = 4, 8, 2048, 0.01
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, size: int = 2048, separator: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """A row per piece; with_ids adds its ids as little-endian 32-bit numbers in a binary column."""
    path = tokenizer or tokens.default_path()
    end = np.array([separator], "<u4").tobytes()

    def run(batches):
        encode = tokens.encoder(path).encode
        for batch in slices(batches):
            doc, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(doc), 1024):
                rows: list[tuple] = []
                for i, raw in zip(doc[at : at + 1024], encode([t or "" for t in texts[at : at + 1024]])):
                    raw += end
                    for n, x in enumerate(range(0, len(raw), 4 * size)):
                        part = raw[x : x + 4 * size]
                        rows.append((i, n, n * size, len(part) // 4, zlib.crc32(part), part))
                columns = list(zip(*rows)) or [[]] * 6
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)][: 5 + with_ids], names=names[: 5 + with_ids])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(leanly(run, tokens.encoder, keep=True), PIECE + ", ids binary" * with_ids)


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each item: longest first, each into the fullest bin with room for it."""
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(size + 1)]  # by places left
    some, made = 0, 0  # bit r: a bin with r places left exists
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fit = some >> n
        if fit:
            left = n + (fit & -fit).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                some ^= 1 << left
        else:
            left, b, made = size, made, made + 1
        bins[i], places[i] = b, size - left
        room[left - n].append(b)
        some |= 1 << (left - n)
    return bins, places


def _packed(pdf: pd.DataFrame, size: int, last: bool, level: int) -> pd.DataFrame:
    """One group of one round: bins of the round before are the items; rows get their bin's new number and place."""
    item, first = np.unique(pdf["bin"].to_numpy(), return_inverse=True)
    lengths = np.bincount(first, pdf["length"], len(item)).astype(np.int64)
    bins, places = best_fit(lengths, size)
    used = np.bincount(bins, lengths).astype(np.int64)
    final = np.ones(len(used), bool)
    if not last:
        final = size - used <= SLACK
    number = (level << 56) + (int(pdf["cell"].iloc[0]) << 20) + bins[first]
    return pdf.assign(bin=number, offset=pdf["offset"].to_numpy() + places[first], final=final[bins[first]])


def _packer(size: int, last: bool, level: int):
    return lambda pdf: _packed(pdf, size, last, level)


def packed(parts: DataFrame, size: int = 2048, gain: float = GAIN) -> DataFrame:
    """The pieces with sequence_id and offset; parts is a written table with a column length of at most size.

    gain: rounds end when one puts less than this share of its bins into others; with 0 they go on to the last group.
    """
    bins = parts.count()
    cells = max(1, -(-bins // ITEMS))
    at = F.monotonically_increasing_id()
    todo = parts.withColumns({"bin": at, "cell": F.pmod(F.xxhash64(at), F.lit(cells)), "offset": F.lit(0).cast("long"), "final": F.lit(False)})
    done, level = [], 0
    while True:
        level += 1
        now = written(todo.groupBy("cell").applyInPandas(_packer(size, cells == 1, level), todo.schema), "packed")
        done.append(now.where("final"))
        if cells == 1:
            break
        rest = now.where("not final")
        left = rest.where("offset = 0").count()  # a bin has one row there
        if gain and left > (1 - gain) * bins:
            done.append(rest)
            break
        fewer = max(1, -(-cells // FAN), -(-left // ITEMS))
        todo, bins, cells = rest.withColumn("cell", F.expr(f"cell * {fewer} div {cells}")), left, fewer
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.withColumnRenamed("bin", "sequence_id").drop("cell", "final")


def pack(docs: DataFrame, size: int = 2048, separator: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, gain: float = GAIN) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece, and its ids if asked for; gain: see packed()."""
    out = packed(written(pieces(docs, size, separator, tokenizer, id_col, text_col, with_ids), "pieces"), size, gain)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("sequence_id"), F.col("offset"), *["ids"] * with_ids)


def sequences(placed: DataFrame) -> DataFrame:
    """A row per sequence: its pieces in order and, if placed has them, its ids; at most size pieces meet in one row."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", *["ids"] * ("ids" in placed.columns))))
    out = placed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length"))
    if "ids" in placed.columns:
        out = out.withColumn("ids", F.aggregate("parts.ids", F.lit(b""), lambda a, x: F.concat(a, x)))
    return out.select("sequence_id", "length", F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("offsets"), *["ids"] * ("ids" in placed.columns))
