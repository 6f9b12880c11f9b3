"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "loomtext", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings every operator assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised stage outputs.

    Uses the context's checkpoint folder or ``spark.checkpoint.dir``. Only a local-mode
    session with neither (tests, laptops) gets a fresh temporary folder; a cluster
    session without a shared folder is an error, because executor-local folders do not
    survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session has no context: use the configured folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set in the SQL conf either
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) on a cluster")
        configured = tempfile.mkdtemp(prefix="loomtext-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it
    back: the lineage is cut, later passes read columns they need only, and the table
    survives the loss of any executor (unlike cached or locally checkpointed blocks).
    Parquet writes columnar and compressed, which is cheaper than serialising rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for a written stage table."""
    base = checkpoint_dir(spark)
    app = spark.conf.get("spark.app.id", "") or str(os.getpid())  # two drivers may share a folder
    path = os.path.join(base, f"{name}-{app}-{next(_counter)}")
    _written.append(path)
    return path


def drop_stages(spark: SparkSession) -> int:
    """Remove the stage tables written so far by this driver, which no frame in use may
    still read; the number of paths removed. For the end of a query or job."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _written:
        at = hadoop(_written.pop())
        gone += bool(at.getFileSystem(conf).delete(at, True))
    return gone


def _count():
    n = 0
    while True:
        n += 1
        yield n


_counter = _count()
_written: list[str] = []
