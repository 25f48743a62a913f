"""Text files and stored versions of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import versions as committed

NAME = r"([^/]+)_([0-9]+)_([0-9]{8}T[0-9]{6}Z)\.csv"


def csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a given schema: no inference, and integers too large for a type are read as text."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def versions(spark: SparkSession, folder: str) -> DataFrame:
    """(path, label, id, stamp) of the files named <label>_<id>_<stamp>.csv in a folder; other files are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path")
    part = lambda i: F.regexp_extract("path", NAME, i)
    return files.where(F.col("path").rlike(NAME)).select("path", part(1).alias("label"), part(2).alias("id"), part(3).alias("stamp"))


def latest(found: DataFrame, labels: dict[str, str] | None = None) -> DataFrame:
    """(label, id, path, stamp): the newest version of each id; an id without a label of its own goes by query_<id>."""
    newest = found.groupBy("id").agg(F.max_by("path", "stamp").alias("path"), F.max("stamp").alias("stamp"))
    if labels is None:
        return newest.withColumn("label", F.concat(F.lit("query_"), "id"))
    names = found.sparkSession.createDataFrame(list(labels.items()) or [("", "")], "id string, label string")
    return newest.join(F.broadcast(names), "id", "left").withColumn("label", F.coalesce("label", F.concat(F.lit("query_"), "id")))


def load(spark: SparkSession, folder: str, label: str, schema: T.StructType | str, labels: dict[str, str] | None = None) -> DataFrame:
    """The newest version of a label; a KeyError if there is none. The list of versions is a folder's listing."""
    paths = [r.path for r in latest(versions(spark, folder), labels).where(F.col("label") == label).select("path").collect()]
    if not paths:
        raise KeyError(label)
    return csv(spark, paths, schema)


def list_tables(spark: SparkSession, folder: str, labels: dict[str, str] | None = None) -> dict[str, str]:
    """Name of the newest file of each label in a folder."""
    return {r.label: r.path.rsplit("/", 1)[-1] for r in latest(versions(spark, folder), labels).select("label", "path").collect()}


def load_all(spark: SparkSession, folder: str, schemas: dict[str, T.StructType | str], labels: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The newest version of each label that has a schema."""
    found = {r.label: r.path for r in latest(versions(spark, folder), labels).select("label", "path").collect()}
    return {label: csv(spark, found[label], schema) for label, schema in schemas.items() if label in found}


def load_version(spark: SparkSession, folder: str, label: str) -> DataFrame:
    """The newest committed version of a panel that panels.written_version has stored; a KeyError if there is none."""
    return committed.read(spark, folder, label)
