"""Session helpers for tests and the bench.

Library functions never build a session: the caller owns it. These helpers
only give tests and ``bench.py`` one consistent local configuration and
resolve the shared checkpoint folder the cluster names.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tillroll") -> SparkSession:
    """A local session with AQE and UTC time, as used by tests and bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is only
    read. If it is unset but the SparkContext already has a checkpoint folder,
    that one is used. Only when neither exists and the master is local (tests)
    is a fresh scratch folder assigned; on a cluster that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder on shared storage "
                           "that every executor can write (a machine-local folder would not "
                           "survive an executor loss)")
    local = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local
