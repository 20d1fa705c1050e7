"""Sharding by a Feistel permutation with cycle walking (law ``rows``).

Every row gets a global number 0..n-1 in an order fixed by the data alone. A
keyed Feistel network permutes the numbers: an index is split into two digits
of a rectangle a x b that just covers n, each round adds a hash of one digit to
the other, and an index that falls outside 0..n-1 is permuted again (cycle
walking) until it lies inside. The permuted number p gives shard = p mod shards
and slot = p div shards, so shard sizes differ by one row at most and anyone who
knows (n, key) can compute where a row number lies, with no table at all.

Only DataFrame functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable
from .numbering import bucket_offsets

ROWS_PER_BUCKET = 8192
ROUNDS = 6
WALKS = 24          # steps allowed outside 0..n-1; each leaves with probability 1 - n**-0.5
SPREAD = 65536      # copies of one repeated row that are numbered together


def rectangle(n: int) -> tuple[int, int]:
    """Smallest a x b with a = ceil(sqrt(n)) that covers n."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def feistel(index: Column, n: int, key: int) -> Column:
    """Keyed permutation of 0..n-1."""
    a, b = rectangle(n)
    rounds = F.array(*[F.lit(key * ROUNDS + i).cast("long") for i in range(ROUNDS)])

    def permute(x: Column) -> Column:
        start = F.struct(F.floor(x / b).cast("long").alias("u"), (x % b).cast("long").alias("v"),
                         F.lit(a).cast("long").alias("mu"), F.lit(b).cast("long").alias("mv"))
        return F.aggregate(
            rounds, start,
            lambda s, k: F.struct(
                s["v"].alias("u"),
                ((s["u"] + F.pmod(F.xxhash64(s["v"], k), s["mu"])) % s["mu"]).alias("v"),
                s["mv"].alias("mu"), s["mu"].alias("mv")),
            lambda s: s["u"] * F.lit(b).cast("long") + s["v"])

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), permute(index),
                         lambda x, _: F.when(x < n, x).otherwise(permute(x)))
    return F.when(walked < n, walked).otherwise(
        F.raise_error(F.lit("cycle walk did not return")).cast("long"))


def global_row_numbers(rows: DataFrame, cols: list[str]) -> tuple[DataFrame, int]:
    """(rows with ``row_no`` 0..n-1, n). The order depends on the values of
    ``cols`` alone. Rows equal in all of them are counted first and then take
    consecutive numbers, so a row repeated any number of times stays one row
    until the numbers are dealt."""
    counted = durable(rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies")), "shard-rows")
    n = counted.agg(F.sum("_copies")).first()[0] or 0
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    dealt = counted.select("*", F.pmod(F.xxhash64(*cols), F.lit(buckets)).alias("_bucket"))
    before = bucket_offsets(dealt, [], "_bucket", "_copies")
    inside = W.partitionBy("_bucket").orderBy(*cols).rowsBetween(W.unboundedPreceding, -1)
    first = (dealt.select("*", F.coalesce(F.sum("_copies").over(inside), F.lit(0)).alias("_in"))
             .join(before, "_bucket")
             .select(*cols, "_copies", (F.col("before") + F.col("_in")).alias("_first")))
    parts = first.select(*cols, "_copies", "_first", F.explode(
        F.expr(f"sequence(0L, _copies - 1, {SPREAD}L)")).alias("_from"))
    return parts.select(*cols, F.explode(F.sequence(
        F.col("_first") + F.col("_from"),
        F.col("_first") + F.least(F.col("_copies"), F.col("_from") + SPREAD) - 1)
    ).alias("row_no")), n


def shard_rows(docs: DataFrame, shards: int = 40, key: int = 20_240) -> DataFrame:
    """Shard and slot of every row of ``docs`` (``doc_id``, ``text``).

    Returns doc_id, size (UTF-8 bytes of the text, 0 for null, plus 16),
    text_crc32 (0 for a null text), law (``rows``), shard, slot, grown_shard
    (null: another shard count moves all rows under this law), row_no.

    Null ids and texts are ordinary values. Repeated rows are numbered one by
    one; rows equal in (doc_id, size, crc) are interchangeable. An empty table
    gives an empty result. Other columns of the input are not looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long")
        .alias("text_crc32"))
    numbered, n = global_row_numbers(rows, ["doc_id", "size", "text_crc32"])
    placed = numbered.select("*", feistel(F.col("row_no"), n, key).alias("_at"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("_at") % shards).cast("int").alias("shard"),
        F.floor(F.col("_at") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_no")
