"""Fact tables stored for their join: bucketed by the order key, so that line items
meet their orders without an exchange, however often they are joined.

Both tables get the same number of buckets on (key, salt), one file per bucket, sorted.
A key that holds more than ``ROWS_PER_COPY`` lines is salted when it is stored: its
lines are dealt among copies of its order, so no bucket holds one key's third of all
rows. For all other keys the salt is 0 and nothing is copied.

The tables are registered in the session's catalog as external tables under the
shared checkpoint folder (a deployment gives its own path and names).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .durable import durable, scratch_path

ROWS_PER_COPY = 100_000
SALT = "_salt"


@dataclass(frozen=True)
class Bucketed:
    """Names of two tables that join on (``key``, salt) without an exchange."""

    lines: str
    orders: str
    line_key: str
    order_key: str

    def joined(self, spark: SparkSession, lines: list[str], orders: list[str],
               keep: Column | None = None) -> DataFrame:
        """Lines with their order's columns (inner); ``keep`` is a condition on orders'
        columns that reaches their scan."""
        left = spark.table(self.lines).select(self.line_key, F.col(SALT).alias("_left_salt"), *lines)
        right = spark.table(self.orders)
        if keep is not None:
            right = right.filter(keep)
        right = right.select(self.order_key, SALT, *orders)
        on = (F.col(self.line_key) == F.col(self.order_key)) & (F.col("_left_salt") == F.col(SALT))
        return left.join(right, on).drop("_left_salt", SALT)

    def drop(self, spark: SparkSession) -> None:
        """Forget the tables (the files go with ``durable.release``)."""
        for name in (self.lines, self.orders):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _store(df: DataFrame, name: str, key: str, buckets: int, path: str) -> None:
    """One file per bucket: rows are dealt the way buckets are before they are written."""
    (df.repartition(buckets, key, SALT).write.mode("error").option("path", path)
     .bucketBy(buckets, key, SALT).sortBy(key, SALT).format("parquet").saveAsTable(name))


def store_fact(lines: DataFrame, orders: DataFrame, line_key: str, order_key: str, spread_by: list[str],
               buckets: int, rows_per_copy: int = ROWS_PER_COPY) -> Bucketed:
    """Store ``lines`` and ``orders`` for their inner join on the keys. ``spread_by``
    are columns of ``lines`` that tell a key's lines apart. Null keys join nothing and
    are not stored with the orders' copies beyond one."""
    spark = lines.sparkSession
    copies = F.ceil(F.col("_n") / rows_per_copy)
    hot = durable(lines.filter(F.col(line_key).isNotNull()).groupBy(F.col(line_key).alias("_key"))
                  .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_copy)
                  .select("_key", copies.alias("_copies")), "hot-keys")
    of = F.coalesce("_copies", F.lit(1).cast("long"))
    left = lines.join(hot, F.col(line_key) == F.col("_key"), "left").withColumn(
        SALT, F.pmod(F.xxhash64(*spread_by), of).cast("int")).drop("_key", "_copies")
    right = orders.join(hot, F.col(order_key) == F.col("_key"), "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), (of - 1).cast("int")))).drop("_key", "_copies")
    tag = uuid.uuid4().hex[:12]
    stored = Bucketed(f"lines_{tag}", f"orders_{tag}", line_key, order_key)
    _store(left, stored.lines, line_key, buckets, scratch_path(spark, "bucketed-lines"))
    _store(right, stored.orders, order_key, buckets, scratch_path(spark, "bucketed-orders"))
    return stored
