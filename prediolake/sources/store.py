"""The listings table in versions: a new one is written beside the old, then a pointer is swapped."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..schemas import STORED


class ListingStore:
    """Parquet partitioned by portal under root/v=N, and a pointer file. A reader has whole versions; a failed write leaves the old one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The current version; 0: the table is empty."""
        pointers = self._path(f"{self.root}/pointer")
        if not self._fs.exists(pointers):
            return 0
        return max((int(s.getPath().getName()) for s in self._fs.listStatus(pointers)), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).parquet(f"{self.root}/v={version}").select(*STORED.names)

    def commit(self, change: Callable[[DataFrame], DataFrame], keep: int = 3) -> int:
        """Write change(current) as the next version. Of two writers of one version, one fails. Versions before the last ``keep`` are removed."""
        now = self.version()
        new = now + 1
        change(self.read(now)).select(*STORED.names).write.mode("errorifexists").partitionBy("portal").parquet(f"{self.root}/v={new}")
        out = self._fs.create(self._path(f"{self.root}/pointer/{new}"), False)
        out.write(bytearray(json.dumps({"version": new, "at": time.time()}).encode()))
        out.close()
        for old in range(1, new - keep + 1):
            self._fs.delete(self._path(f"{self.root}/pointer/{old}"), True)
            self._fs.delete(self._path(f"{self.root}/v={old}"), True)
        return new

    def backup(self, folder: str, stamp: str) -> str | None:
        """A copy of the current version as folder/listings_{stamp}; None if there is none."""
        now = self.version()
        if not now:
            return None
        path = f"{folder.rstrip('/')}/listings_{stamp}"
        self.read(now).write.partitionBy("portal").parquet(path)
        return path

    def alive(self) -> bool:
        """Whether the session answers."""
        return self.spark.range(1).count() == 1
