"""SparkSession helpers.

The cluster decides where lineage cuts go: ``spark.checkpoint.dir`` is read
from the session and only set here when it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that every job relies on. AQE re-plans joins at runtime from the
# measured size of each side (broadcast only when the materialised side is
# small, sort-merge otherwise) and splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "quartermaster", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    On a cluster pass ``master=None`` so spark-submit decides; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("QM_DRIVER_MEMORY", "8g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():  # setting it again would open a folder inside it each time
        return sc.getCheckpointDir()
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        # Only reached when the session names no shared folder: local runs and tests.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="qm-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cut(df):
    """Cut the lineage with a reliable checkpoint in the session's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
