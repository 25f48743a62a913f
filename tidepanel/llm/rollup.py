"""Token counts as rollups that deltas maintain: additive totals by source, language and tokenizer version.

A change is an insert, a delete or a revision of a document's count under one tokenizer version. It is signed (+1
document and its tokens, -1 and its tokens, 0 and the difference), and a batch of changes is reduced to one row per
group before it is stored, so totals are sums of sums and no document is read again. A batch has an id and is committed
once: when its sums have been written, a marker of one row is; without the marker they do not count. Committing
a batch again changes nothing, and one that failed halfway is written anew.

Defined results: null sources, languages and versions are groups of their own; a null count is 0, an empty or null text has no
tokens; very long texts are counted whole; repeated rows count each; groups whose documents and tokens are all 0 stay, as the
record of what came and went; without committed batches there are no totals, and an empty table commits an empty batch; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import leanly, slices

GROUP = ["source", "lang", "version"]
TOTALS = "source string, lang string, version string, n_docs long, n_tokens long, n_chars long"


def counted(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", also: Mapping[str, Callable[[list[str]], list[int]]] | None = None) -> DataFrame:
    """id_col, source, lang, n_tokens and n_chars of each row; a null text has none.

    Counts are those of a word-level vocabulary file; also adds columns of counts by other functions of texts, in the same pass.
    """
    path, also = tokenizer or tokens.default_path(), dict(also or {})

    def run(batches):
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(3).to_pylist()]
            n = [len(x) // 4 for x in tokens.encoder(path).encode(texts)]
            counts = [n, map(len, texts), *(count(texts) for count in also.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, pa.int64()) for c in counts)], names=["id", "source", "lang", "n_tokens", "n_chars", *also])

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col(text_col).cast("string").alias("text"))
    shape = ", ".join([f"id {kind}", "source string", "lang string", "n_tokens long", "n_chars long", *(f"{c} long" for c in also)])
    return own.mapInArrow(leanly(run, tokens.encoder, tokens.byte_encoder), shape).withColumnRenamed("id", id_col)


def inserts(rows: DataFrame, version: str) -> DataFrame:
    return _signed(rows, version, 1, F.col("n_tokens"), F.col("n_chars"))


def deletes(rows: DataFrame, version: str) -> DataFrame:
    return _signed(rows, version, -1, -F.col("n_tokens"), -F.col("n_chars"))


def revisions(rows: DataFrame, version: str, new_tokens: str = "new_tokens") -> DataFrame:
    """rows with the counts before (n_tokens) and after (new_tokens); documents and characters stay."""
    return _signed(rows, version, 0, F.coalesce(new_tokens, F.lit(0)) - F.coalesce("n_tokens", F.lit(0)), F.lit(0))


def _signed(rows: DataFrame, version: str, docs: int, tokens_: F.Column, chars: F.Column) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("version"), F.lit(docs).cast("long").alias("n_docs"), F.coalesce(tokens_, F.lit(0)).alias("n_tokens"), F.coalesce(chars, F.lit(0)).cast("long").alias("n_chars"))


def summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in ("n_docs", "n_tokens", "n_chars")))


class Rollup:
    """Totals in a folder, one subfolder per batch with its sums and one with its marker."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def committed(self, batch: str) -> bool:
        try:
            return not self.spark.read.schema("batch string").parquet(f"{self.path}/committed/batch={batch}").isEmpty()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store a batch's sums; False, and nothing done, if it was committed before."""
        if self.committed(batch):
            return False
        summed(changes).write.mode("overwrite").parquet(f"{self.path}/sums/batch={batch}")
        self.spark.range(1).select(F.lit(batch).alias("batch")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/committed/batch={batch}")
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """Sums over those of the batches that are committed."""
        own = [f"{self.path}/sums/batch={b}" for b in dict.fromkeys(batches) if self.committed(b)]
        rows = self.spark.read.schema(TOTALS).parquet(*own) if own else self.spark.createDataFrame([], TOTALS)
        return summed(rows)
