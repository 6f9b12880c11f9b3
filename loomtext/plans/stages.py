"""Stage tables that outlive a run, so a stopped job goes on where it was.

A stage's folder is named by a fingerprint of the input files (path, size, time of change),
of the parameters that lead to it and of its own name. Spark marks a folder with
``_SUCCESS`` when every task of a write has committed; only such a folder is read again,
any other is written anew. A changed input or parameter gives other folders, so nothing
stale is read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.session import reliable_checkpoint

COMMITTED = "_SUCCESS"


def input_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """One value for the files under ``paths``: their number and the sum of the hashes of
    (path, size, time of change). Contents are not read."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    count, total = files.agg(F.count(F.lit(1)), F.sum(each)).first()
    return f"{count}:{total}"


class Stages:
    """The stages of one job under ``folder`` (shared by driver and executors). Without a
    folder they are plain stage tables of this run."""

    def __init__(self, spark: SparkSession, folder: str | None, inputs: list[str]):
        self.spark, self.folder = spark, folder
        self.key = input_fingerprint(spark, inputs) if folder else ""

    def path(self, name: str, **params) -> str:
        """Where the stage with these parameters is."""
        key = json.dumps([self.key, name, params], sort_keys=True)
        return f"{self.folder}/{name}-{hashlib.sha256(key.encode()).hexdigest()[:24]}"

    def committed(self, path: str) -> bool:
        """Whether a write of ``path`` was finished."""
        mark = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, COMMITTED)
        return mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)

    def keep(self, name: str, build: Callable[[], DataFrame], **params) -> DataFrame:
        """The stage ``name``: read if an earlier run finished it, else built and written.
        ``params`` are all the parameters, of earlier stages too, that its rows depend on."""
        if not self.folder:
            return reliable_checkpoint(build(), name)
        path = self.path(name, **params)
        if not self.committed(path):
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)
