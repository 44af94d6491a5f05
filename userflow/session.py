"""Session settings and the shared folder used to cut lineage or store models."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins at run time: a side is
# broadcast only when its measured size is under the threshold, skewed
# shuffle partitions are split, small ones coalesced.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Semi joins of a large log (Spark's 10 GB at least) with an id set too big to
    # broadcast: a Bloom filter of at most 64 MB goes to the scan.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "50000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "201326592",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "536870912",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "userflow",
                  extra: dict | None = None) -> SparkSession:
    """A session for tests and local runs.  On a cluster use the cluster's
    session and only apply :data:`SESSION_CONF`."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only a local master may go without it (tests, local
    runs): a fresh folder is then created and registered as the checkpoint
    folder.  Elsewhere each executor would write to a disk of its own, so a
    missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the server's setting counts
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    local = sc is not None and sc.master.split("[")[0] == "local"
    if not configured and not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="userflow-ckpt-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A new unique path below the shared folder."""
    return os.path.join(shared_dir(spark), *parts, uuid.uuid4().hex)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet to a new folder under the shared checkpoint
    folder and continue from the written copy: later consumers do not
    recompute its plan, the lineage is cut, losing an executor loses none of
    it, and the planner sees the real size of the data.  (An RDD checkpoint
    would compute the plan twice: once to count, once to write.)"""
    spark = df.sparkSession
    path = shared_path(spark, "tables")
    df.write.mode("error").parquet(path)
    _WRITTEN.append(path)
    return spark.read.parquet(path)


_WRITTEN: list[str] = []


def release(spark: SparkSession) -> int:
    """Remove the copies that :func:`materialize` wrote in this process, once
    nothing reads them any more; returns how many there were."""
    n = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n
