"""Materialize an intermediate table in the cluster's shared checkpoint folder.

Used where one intermediate feeds several branches of a plan (a per-customer
table feeding both its percentile cut points and the scored rows; a
basket-item table feeding totals, lookups and the pair join). Catalyst prunes
each branch to different columns, so their shuffles are not reused and the
whole upstream join would run once per branch. Writing the intermediate once
as Parquet under ``spark.checkpoint.dir`` and reading it back:

* runs the upstream plan exactly once,
* cuts the lineage at durable shared storage, so a lost executor re-reads
  files instead of recomputing the star join,
* keeps later reads columnar and column-pruned.

Copies stay until ``release`` deletes this application's folder of them.
The folder comes from the session (``spark.checkpoint.dir``); it is never a
machine-local temp folder on a cluster. Only when it is unset (local tests)
does ``tillroll.session.ensure_checkpoint_dir`` assign one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def durable(df: DataFrame, name: str = "intermediate") -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and return
    a DataFrame that reads it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's shared folder; ``release`` deletes it."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession) -> str:
    """This application's folder for its copies."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tillroll/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete all copies this application has written. DataFrames that read them
    cannot be used afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
