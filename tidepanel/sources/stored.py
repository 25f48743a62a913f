"""Intermediate tables in the folder that driver and executors share, for results that several steps read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset and all runs in one process, a new local folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tidepanel-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read again from a Parquet table: they are computed once, whoever reads them and whichever executor is lost."""
    path = f"{shared_dir(df.sparkSession)}/tidepanel/{name}-{uuid.uuid4().hex}"
    _written.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables written by each application.
_written: dict[str, list[str]] = {}


def clear(spark: SparkSession) -> int:
    """Empty all tables that this application has stored, once the results that read them are written; how many there were."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        spark.createDataFrame([], "none int").write.mode("overwrite").parquet(path)
    return len(paths)
