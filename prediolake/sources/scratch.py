"""Folders for what a job keeps while it runs, where the driver and all executors reach them."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def folder(spark: SparkSession, tag: str) -> str:
    """A new path under spark.checkpoint.dir, removed when the driver's Python ends. Where that is unset: a folder of this machine for a session on one machine (tests), and an error on a cluster."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = _OWN.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="prediolake-")
        _OWN[context.applicationId] = base
    path = f"{base.rstrip('/')}/prediolake-{context.applicationId}/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    with suppress(Exception):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def keep(df: DataFrame, tag: str) -> DataFrame:
    """Write df to a folder and read it back: what follows is computed from files that outlive any executor."""
    path = folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
