"""Session settings and the shared scratch location.

Everything that must be written (landed reports, refreshed tables, lineage cuts) goes under
the folder the cluster names in ``spark.checkpoint.dir``. That setting is read from the
session; only when it is unset (tests, a laptop) do we create a local one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan here relies on. ANSI stays on (Spark 4 default): all lenient parsing
# goes through try_cast / try_to_date explicitly.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size post-shuffle partitions by bytes (advisory 64 MB), not by core count: no swarm of
    # near-empty tasks on small shuffles, full-size partitions on big ones
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # lineage cuts (checkpoint()) are removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidemark", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster the master and partition counts come from spark-submit; ``master`` and
    ``shuffle_partitions`` are for local runs and tests.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # local mode: the driver JVM is the whole cluster
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only when none is configured."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint location for one run."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tidemark/{purpose}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)  # in whatever file system the path names
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return path
