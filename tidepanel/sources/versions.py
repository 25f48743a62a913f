"""Committed versions of tables, and event tables laid out for pruned scans.

A version is data folders and a manifest of one row (schema, rows, folders) that is written last. Readers go by manifests alone, so what a
killed job has left is invisible; a version that is committed already is not written again, so a repeated job changes nothing.
Appending writes only the new rows: the new version's manifest lists the old folders too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "label string, version string, parent string, schema string, rows long, folders array<string>"


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """All committed versions under a folder."""
    try:
        return spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/commits/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)  # nothing is committed yet


def newest(spark: SparkSession, root: str, label: str, version: str | None = None):
    """The manifest of a version, or of the largest one, or None."""
    own = manifests(spark, root).where(F.col("label") == label)
    rows = (own.where(F.col("version") == version) if version else own.orderBy(F.desc("version")).limit(1)).collect()
    return rows[0] if rows else None


def write(df: DataFrame, root: str, label: str, version: str, append: bool = False, partition: str | Sequence[str] | None = None) -> bool:
    """Commit df as a version of a label; with append, after the rows of the newest version. False if the version was there, which stays as it is.

    Versions are text and order by it (UTC stamps, say). Two jobs that commit the same one at a time: one of them fails.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    if newest(spark, root, label, version):
        return False
    last = newest(spark, root, label) if append else None
    if last and version < last.version:
        raise ValueError(f"{version} comes before the newest version, {last.version}")
    folder = f"{root}/data/{label}_{version}-{uuid.uuid4().hex}"
    writer = df.write
    (writer.partitionBy(*([partition] if isinstance(partition, str) else partition)) if partition else writer).parquet(folder)
    there = spark.read.schema(df.schema).parquet(folder).count()
    row = (label, version, last.version if last else None, df.schema.json(), there + (last.rows if last else 0), [*(last.folders if last else []), folder])
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{root}/commits/{label}_{version}")
    return True


def read(spark: SparkSession, root: str, label: str, version: str | None = None) -> DataFrame:
    """The rows of a committed version, the newest one if none is named; a KeyError if there is none. Columns that an older folder lacks are null."""
    own = newest(spark, root, label, version)
    if own is None:
        raise KeyError(label)
    schema = T.StructType.fromJson(json.loads(own.schema))
    parts = [spark.read.schema(schema).parquet(f) for f in own.folders]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select(*schema.names)


def laid_out(events: DataFrame, root: str, label: str, version: str, time: str = "time", key: str = "asset", cells: int = 16, rows_per_file: int = 1_000_000) -> bool:
    """Commit events in folders by date and by cell of the key, in order of key and time within files; a date with many rows has many files."""
    own = events.withColumns({"date": F.to_date(time), "cell": cell(key, cells)})
    n = events.count()
    sorted_ = own.repartitionByRange(max(1, -(-n // rows_per_file)), "date", "cell", key, time).sortWithinPartitions("date", "cell", key, time)
    return write(sorted_, root, label, version, partition=("date", "cell"))


def cell(key: str, cells: int = 16):
    return F.pmod(F.xxhash64(key), F.lit(cells)).cast("int")


def between(laid: DataFrame, lo: str, hi: str, time: str = "time") -> DataFrame:
    """Events with lo <= time < hi: whole dates are pruned by their folders, the rest by a filter that reaches the scan."""
    kind = laid.schema[time].dataType
    first, last = F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
    return laid.where((F.col("date") >= F.to_date(first)) & (F.col("date") <= F.to_date(last)) & (F.col(time) >= F.lit(lo).cast(kind)) & (F.col(time) < F.lit(hi).cast(kind)))


def of_universe(laid: DataFrame, universe: DataFrame, key: str = "asset", cells: int = 16) -> DataFrame:
    """Events whose key is in the universe; folders of cells that it does not touch are pruned while the query runs."""
    wanted = universe.select(key).distinct().withColumn("cell", cell(key, cells))
    return laid.join(wanted, ["cell", key], "left_semi")
