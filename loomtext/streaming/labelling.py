"""Incremental labelling of browse-log files as they land (Structured Streaming).

The batch labelling job reads a day of hourly log folders. The same job as a stream:
a file source over the log folder, each micro-batch labelled by the rule table with
the batch operators, and written with the batch id as an idempotent partition, so a
retried batch replaces its own output (exactly-once at the sink). The best-rule choice
needs no state across records, so the stream holds no aggregation state; one record per
title is the stream that follows (``titles.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomtext.functions.records import last_field
from loomtext.operators.classify import classify, index_rules
from loomtext.sources.text import identified_lines, sampled_lines


def browse_records(lines: DataFrame) -> DataFrame:
    """Raw log lines -> ``(rec_id, line, url, tit, kw)`` (S3: last field wins)."""
    v = F.col("value")
    return lines.select(F.col("rec_id"), v.alias("line"), last_field(v, "url").alias("url"),
                        last_field(v, "tit").alias("tit"), last_field(v, "kw").alias("kw"))


def label_batch(batch: DataFrame, index: DataFrame, batch_id: int) -> DataFrame:
    """One micro-batch: records are named by (batch, rec_id), rec_id from the line's
    content, so a retried batch names them alike. ``index`` is the rule index, stored once
    per stream, not per batch."""
    labelled = classify(browse_records(identified_lines(batch, "rec_id")), None, index=index)
    return labelled.withColumn("batch", F.lit(batch_id))


def start_labelling(spark: SparkSession, source_dir: str, rules: DataFrame, out_dir: str, checkpoint: str,
                    max_files_per_trigger: int = 100, once: bool = False, first: float = 1.0) -> StreamingQuery:
    """Label every new text file under ``source_dir`` into Parquet under ``out_dir``, of
    its lines the sample ``first``.

    ``checkpoint`` must be a shared folder (it holds the source offsets and commit log).
    """
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir)
    stream = sampled_lines(stream, first) if first < 1 else stream
    index = index_rules(rules)

    def write(batch: DataFrame, batch_id: int) -> None:
        labelled = label_batch(batch, index, batch_id)
        (labelled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(out_dir))

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w
    return w.start()
