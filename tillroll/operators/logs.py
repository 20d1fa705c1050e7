"""Error-log analytics over a log table (error_id, timestamp, component,
error_type, error_message): severity and recovery classification, alert
filter, summary counts and a per-period trend.

Everything is a projection or a small aggregation; counts are taken once per
(error_type, severity) with map-side combine and rolled up from that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules


def log_severity(logs: DataFrame) -> DataFrame:
    """Add severity (first keyword tier wins), recovery_route and suggestions."""
    msg = F.col("error_message")
    return logs.withColumns({
        "severity": rules.severity(msg),
        "recovery_route": rules.recovery_route(msg),
        "suggestions": rules.suggestions(F.col("error_type")),
    })


def log_alerts(classified: DataFrame) -> DataFrame:
    """Errors that raise an alert: CRITICAL ones, and those with no recovery route."""
    return classified.filter((F.col("severity") == "CRITICAL") | F.col("recovery_route").isNull())


def log_summary(classified: DataFrame) -> DataFrame:
    """Long form (dimension, key, error_count): total, per error type, per
    severity, plus the most recent error message (error_count null)."""
    base = classified.groupBy("error_type", "severity").agg(F.count("*").alias("n"))
    total = base.agg(F.lit("total").alias("dimension"), F.lit("all").alias("key"),
                     F.sum("n").alias("error_count"))
    by_type = base.groupBy("error_type").agg(F.sum("n").alias("error_count")).select(
        F.lit("error_type").alias("dimension"), F.col("error_type").alias("key"), "error_count")
    by_sev = base.groupBy("severity").agg(F.sum("n").alias("error_count")).select(
        F.lit("severity").alias("dimension"), F.col("severity").alias("key"), "error_count")
    # Keyless max over (timestamp, id): one streaming pass, no sort by group.
    latest = classified.agg(
        F.max(F.struct("timestamp", "error_id", "error_message")).alias("_l")).select(
        F.col("_l.error_message").alias("key")).select(
        F.lit("most_recent_error").alias("dimension"), "key",
        F.lit(None).cast("long").alias("error_count"))
    return total.unionByName(by_type).unionByName(by_sev).unionByName(latest)


def log_trend(classified: DataFrame, period: str = "day") -> DataFrame:
    """Errors per period against the previous period: Increasing / Decreasing /
    Stable (first period: Insufficient data). The window runs over the small
    per-period table, bounded by the calendar."""
    per = (classified.groupBy(F.date_trunc(period, "timestamp").cast("timestamp_ntz")
                              .alias("period_start"))
           .agg(F.count("*").alias("error_count")))
    prev = F.lag("error_count", 1).over(Window.orderBy("period_start"))
    per = per.withColumn("previous_count", prev)
    trend = (F.when(F.col("previous_count").isNull(), "Insufficient data")
             .when(F.col("error_count") > F.col("previous_count"), "Increasing")
             .when(F.col("error_count") < F.col("previous_count"), "Decreasing")
             .otherwise("Stable"))
    return per.withColumn("trend", trend)
