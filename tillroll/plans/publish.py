"""Writers, dataset profiles and the multi-dataset publish plan.

* ``write_table``: Parquet (snappy) or CSV with optional partition columns and
  lineage columns; the row count is observed during the write (``Observation``),
  not recomputed by a second job.
* ``verify_write``: reads the written data back and compares its count with
  the observed count.
* ``dataset_profile``: a one-row profile DataFrame (count as an aggregate),
  appended to a catalog table next to the datasets (never inside a
  partitioned dataset's folder, where Spark would refuse to read it).
* ``publish_all``: stages every table as a new version (``plans.versions``): the
  enriched table first, partitioned by (year, month), then every metric table from
  that written copy, so the lineage is cut at a durable table in shared storage.
  What was written is read back and compared by digest; then all tables become
  current at once.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import baskets as _baskets
from ..operators import cohorts, customers, products, rfm, summary, timeseries
from ..operators.enrich import enrich
from . import versions

# FIXED VALUES: bytes per value by type for the size estimate; others 10.
TYPE_BYTES = [
    (("string", "varchar"), 50),
    (("int", "integer"), 4),
    (("bigint", "long", "double"), 8),
    (("timestamp", "timestamp_ntz", "date"), 8),
]
DEFAULT_TYPE_BYTES = 10

# FIXED VALUES: publish plan, dataset -> (zone, partition columns).
PUBLISH_PLAN = {
    "enriched_transactions": ("processed", ["year", "month"]),
    "customer_metrics": ("curated", ["customer_segment"]),
    "product_metrics": ("curated", ["category"]),
    "rfm_analysis": ("curated", ["rfm_segment"]),
    "cohort_analysis": ("curated", ["cohort_month"]),
    "executive_summary": ("curated", None),
    "weekday_metrics": ("curated", None),
    "monthly_metrics": ("curated", None),
    "market_basket_analysis": ("curated", None),
    "churn_indicators": ("curated", ["churn_risk_level"]),
}


def job_id(now: float | None = None) -> str:
    return f"job_{int(now if now is not None else time.time())}"


def with_lineage(df: DataFrame, etl_job_id: str) -> DataFrame:
    return df.withColumns({"etl_timestamp": F.current_timestamp(),
                           "etl_job_id": F.lit(etl_job_id)})


def write_table(df: DataFrame, path: str, file_format: str = "parquet",
                partition_cols: list[str] | None = None, mode: str = "overwrite",
                etl_job_id: str | None = None) -> int:
    """Write ``df`` (plus lineage columns); return the number of rows written.

    Rows are first rebalanced by the partition columns, so that a partition
    value is written by one task (or a few, where it is large) instead of one
    file by every task."""
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    fmt = file_format.lower()
    obs = Observation("write")
    out = with_lineage(df, etl_job_id or job_id()).observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode)
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
        if partition_cols:
            writer = writer.partitionBy(*partition_cols)
        writer.parquet(path)
    elif fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        raise ValueError(f"Unsupported file format: {file_format}")
    return int(obs.get["rows"])


def verify_write(spark: SparkSession, path: str, expected_rows: int,
                 file_format: str = "parquet") -> bool:
    """Read the written data back and compare its row count."""
    reader = spark.read.option("header", "true") if file_format == "csv" else spark.read
    got = reader.format(file_format).load(path).count()
    return got == expected_rows


def row_bytes(df: DataFrame) -> int:
    total = 0
    for _, t in df.dtypes:
        total += next((b for kinds, b in TYPE_BYTES if t in kinds), DEFAULT_TYPE_BYTES)
    return total


def dataset_profile(df: DataFrame, path: str, file_format: str = "parquet",
                    partition_cols: list[str] | None = None,
                    record_count: int | None = None) -> DataFrame:
    """One row: dataset_path, record_count, column_count, column_names,
    schema_json, file_format, partition_columns, size_estimate_mb (2 dp).

    The count is an aggregate over ``df`` unless already known (e.g. observed
    during the write), in which case ``df`` is not scanned again."""
    per_row = row_bytes(df)
    if record_count is None:
        counted = df.agg(F.count(F.lit(1)).alias("record_count"))
    else:
        counted = df.sparkSession.range(1).select(F.lit(record_count).cast("long")
                                                  .alias("record_count"))
    return counted.select(
        F.lit(path).alias("dataset_path"), "record_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("column_names"),
        F.lit(df.schema.json()).alias("schema_json"),
        F.lit(file_format).alias("file_format"),
        F.lit(",".join(partition_cols or [])).alias("partition_columns"),
        (F.round(F.col("record_count") * F.lit(per_row) / F.lit(1048576.0) * F.lit(100.0))
         / F.lit(100.0)).alias("size_estimate_mb"),
    )


def append_profile(profile: DataFrame, catalog_path: str) -> None:
    """Append a profile row (with its creation time) to the catalog table."""
    profile.withColumn("created_timestamp", F.current_timestamp()) \
        .write.mode("append").parquet(catalog_path)


def derived_tables(enriched: DataFrame) -> dict[str, DataFrame]:
    """Every published metric table, derived from one enriched table."""
    lifetime = customers.clv_segments(customers.customer_lifetime(enriched))
    base = rfm.rfm_base(enriched)
    return {
        "customer_metrics": lifetime,
        "product_metrics": products.product_performance(enriched),
        "rfm_analysis": rfm.rfm_segments(base),
        "cohort_analysis": cohorts.cohort_retention(enriched),
        "executive_summary": summary.executive_summary(summary.executive_totals(enriched)),
        "weekday_metrics": timeseries.weekday_series(enriched),
        "monthly_metrics": timeseries.monthly_series(enriched),
        "market_basket_analysis": _baskets.basket_pairs(enriched),
        "churn_indicators": customers.churn_indicators(lifetime),
    }


def publish_all(spark: SparkSession, star: dict[str, DataFrame], root: str,
                etl_job_id: str | None = None) -> dict[str, int]:
    """Stage every dataset under ``root`` following ``PUBLISH_PLAN``, verify it,
    and switch all of them at once (``versions.read_current`` reads them). A profile
    per dataset is appended to ``root/_catalog``. Returns rows written by name. A
    run that fails before the switch leaves the old tables current."""
    jid = etl_job_id or job_id()
    root = root.rstrip("/")
    version = versions.new_version(spark, root)
    staged: dict[str, versions.Staged] = {}

    def put(name: str, df: DataFrame) -> None:
        zone, parts = PUBLISH_PLAN[name]
        staged[name] = versions.stage(with_lineage(df, jid), root, zone, name, version, parts or ())

    enriched = enrich(star["transactions"], star["customers"], star["products"])
    put("enriched_transactions", enriched)
    copy = spark.read.schema(enriched.schema).parquet(staged["enriched_transactions"].path)
    tables = derived_tables(copy)
    for name, df in tables.items():
        put(name, df)
    versions.switch(spark, root, version, list(staged.values()))
    for name, df in {"enriched_transactions": enriched, **tables}.items():
        append_profile(dataset_profile(df, staged[name].path, "parquet", PUBLISH_PLAN[name][1],
                                       record_count=staged[name].rows), f"{root}/_catalog")
    return {name: s.rows for name, s in staged.items()}


def replace_partitions(df: DataFrame, root: str, name: str, etl_job_id: str | None = None) -> int:
    """Publish ``df`` in place of the partitions of ``name`` that it holds rows of;
    other partitions and tables stay as they are. Returns the rows written."""
    spark = df.sparkSession
    zone, parts = PUBLISH_PLAN[name]
    if not parts:
        raise ValueError(f"{name} has no partitions")
    version = versions.new_version(spark, root)
    staged = versions.stage(with_lineage(df, etl_job_id or job_id()), root, zone, name, version, parts)
    versions.switch(spark, root, version, [staged], replace="partitions")
    return staged.rows


def published_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Per current table: zone, partitions, rows by its manifest and by its files'
    footers, files, bytes, data versions, and whether all digests still agree."""
    listed = versions.manifest(spark, root).groupBy("table", "zone").agg(
        F.count_if(F.col("rows") > 0).alias("partitions"), F.sum("rows").alias("record_count"))
    checked = versions.verify_current(spark, root).groupBy("table").agg(F.bool_and("passed").alias("verified"))
    files = versions.footprint(spark, root).withColumnRenamed("rows", "footer_rows")
    return (listed.join(files, "table").join(checked, "table", "left")
            .withColumn("verified", F.coalesce("verified", F.lit(True))).withColumnRenamed("table", "dataset"))
