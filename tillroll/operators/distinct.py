"""Exact distinct counts that can be merged, as bucketed bitmaps.

A 64-bit id falls into a bucket of 32,768 ids and a bit of its bitmap (4 KB). Bitmaps
of days merge into months, quarters or any coarser period by OR, so a day's table
is built once and its rows are never read again, and no row is expanded.

Made for few groups with many ids each (periods, totals): there a bitmap is well
filled. For many groups with few ids (products per customer), or for two id
columns at once, most bitmaps would be nearly empty and move more bytes than the ids;
``count_distinct`` stays there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable

def distinct_bitmaps(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """(``by``, bucket, bitmap): the ids of integer ``column`` in each group. Null
    ids are left out; ids may be negative.

    Ids are made distinct first (with map-side combine, so a hot id is one row a
    task), then brought together by bucket: each bitmap is built once, in one task,
    instead of as a nearly empty 4 KB part in every map task."""
    ids = (df.filter(F.col(column).isNotNull())
           .select(*by, F.col(column).cast("long").alias("id")).distinct()
           .withColumn("bucket", F.bitmap_bucket_number("id")))
    return (ids.repartition(*by, "bucket").groupBy(*by, "bucket")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap")))


def merge_bitmaps(bitmaps: DataFrame, by: list[Column | str]) -> DataFrame:
    """The bitmaps of coarser groups: ``by`` are columns derived from the finer ones."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(bitmaps: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct ids of each group; without ``by``, one row."""
    return bitmaps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))


LEVELS = ("day", "month", "quarter", "year", "all")


def active_by_period(enriched: DataFrame, column: str = "customer_id", name: str = "active") -> DataFrame:
    """period_level (day, month, quarter, year, all), period_start (date; null for
    all) and the exact number of distinct ids. Days are counted from the rows and
    written once; every other level merges the bitmaps of the level below it."""
    days = durable(distinct_bitmaps(enriched.withColumn("period_start", F.to_date("transaction_date")),
                                    ["period_start"], column), "day_bitmaps")
    parts, below = [], days
    for level in LEVELS:
        if level != "day":
            start = F.lit(None).cast("date") if level == "all" else F.to_date(F.date_trunc(level, "period_start"))
            below = merge_bitmaps(below, [start.alias("period_start")])
        parts.append(count_bitmaps(below, ["period_start"], name).select(
            F.lit(level).alias("period_level"), "period_start", name))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
