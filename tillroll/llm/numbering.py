"""Prefix sums over hash buckets, the building block of global row numbers and
of word offsets inside a source.

A window over a whole table (or a whole source) would put all of it in one
task. Rows are dealt into buckets of a bounded expected size instead; a window
runs inside each bucket, and the total of all earlier buckets is added. The
bucket totals are themselves summed in two levels, so the widest window holds
one row for every ``FAN`` buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FAN = 4096


def bucket_offsets(rows: DataFrame, by: list[str], bucket: str, amount: str) -> DataFrame:
    """One row per (``by``, ``bucket``): ``before``, the sum of ``amount`` over
    all smaller buckets of the same ``by`` group. Null amounts count as 0."""
    group = F.floor(F.col(bucket) / FAN).alias("_group")
    totals = (rows.groupBy(*by, bucket).agg(F.coalesce(F.sum(amount), F.lit(0)).alias("_total"))
              .select("*", group))
    inner = (W.partitionBy(*by, "_group").orderBy(bucket)
             .rowsBetween(W.unboundedPreceding, -1))
    inside = totals.select("*", F.coalesce(F.sum("_total").over(inner), F.lit(0)).alias("_inside"))
    outer = W.partitionBy(*by).orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    groups = (totals.groupBy(*by, "_group").agg(F.sum("_total").alias("_total"))
              .select(*by, "_group",
                      F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_earlier")))
    a, b = inside.alias("a"), groups.alias("b")
    same = F.col("a._group") == F.col("b._group")
    for c in by:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, same).select(*[F.col(f"a.{c}").alias(c) for c in by],
                                  F.col(f"a.{bucket}").alias(bucket),
                                  (F.col("_inside") + F.col("_earlier")).alias("before"))
