"""A6 over a stream: one labelled record per title, kept up as hours of logs land.

The labelling stream writes its records as a Parquet table; this stream follows that table
and keeps, per title, the smallest line seen so far as state. The choice is a minimum, so
an hour that is delivered twice, split over batches or late changes nothing, and the
result is the batch job's over all hours.

A batch writes only the titles whose record changed: the state carries the time of the
batch that brought the record beside the time of the title's last batch (a batch's
``current_timestamp`` is one value, logged with its offsets, so a retry sees the same).
The written changes only ever fall, so the current records are their minimum per title,
whatever batches a reader finds.

State is one record per title and grows with the titles: it is held by the RocksDB
provider, on disk, its change log under ``checkpoint``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomtext.operators.sampling import one_per_title, picked_lines

LABELLED = "tit string, tag string, line string, batch int"  # what is read of the labelling stream's table
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def changed_titles(labelled: DataFrame) -> DataFrame:
    """Of a stream of ``(tit, tag, line)``: ``(tit, line, tag)`` of the titles whose
    smallest line arrived in this batch. Records without a title are one group."""
    seen = labelled.withColumn("seen", F.current_timestamp())
    best = seen.groupBy("tit").agg(F.min(F.struct("line", "seen", "tag")).alias("best"), F.max("seen").alias("latest"))
    return best.where(F.col("best.seen") == F.col("latest")).select("tit", "best.line", "best.tag")


def start_one_per_title(spark: SparkSession, labelled_dir: str, out_dir: str, checkpoint: str, second: float = 0.1,
                        max_files_per_trigger: int = 1000, once: bool = False) -> StreamingQuery:
    """Follow the table that :func:`loomtext.streaming.labelling.start_labelling` writes,
    sample it and write each batch's changed records under ``out_dir``, a partition per
    batch, so a retried batch replaces its own. ``checkpoint`` must be a shared folder."""
    own = spark.newSession()  # the state provider is this stream's setting, not the caller's
    for key, value in STATE.items():
        own.conf.set(key, value)
    labelled = own.readStream.schema(LABELLED).option("maxFilesPerTrigger", max_files_per_trigger).parquet(labelled_dir)
    changed = changed_titles(picked_lines(labelled, second))

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out_dir))

    w = changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w
    return w.start()


def current_records(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(tit, line, tag)``: the record of each title so far."""
    return one_per_title(spark.read.parquet(out_dir))
