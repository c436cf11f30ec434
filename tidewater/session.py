"""Session helpers: a local session for tests/bench and the shared staging folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Local-mode defaults used by tests and bench.py. On a cluster the session comes from
# spark-submit and none of these are forced by the library.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Small local inputs: without this AQE coalesces a whole rebalance shuffle of a few MB
    # into one task, and a write into thousands of day partitions then creates every file
    # serially. Cluster-size data never gets near this floor.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewater",
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Staged change sets and job scratch data go below it so that a lost executor never
    loses data another stage still needs. The setting is read from the session; only a
    local-mode session without one gets a private temporary folder (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster has processes of its own
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(folder)
    return (sc.getCheckpointDir() or folder).rstrip("/")


def scratch_path(spark: SparkSession, kind: str, label: str) -> str:
    """A fresh, unique folder name below the shared root (not created)."""
    token = os.urandom(6).hex()
    return f"{shared_root(spark)}/tidewater-{kind}/{label}-{token}"
