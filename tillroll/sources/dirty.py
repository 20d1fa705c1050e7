"""The star tables with faults put in, for checks that clean tables never fail.

A hash of each row's key decides which rows lose a value, are repeated, point to
a parent that does not exist, or hold an extreme amount, so the faults are the same
on every run and in every engine. Everything is a projection over the whole
table (a repeated row is one exploded element); no row is chosen by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import model

# ---------------------------------------------------------------- fixed values
# Rows of a thousand that have a fault.
NULL_CUSTOMER = 70        # transactions without a customer
ORPHAN_CUSTOMER = 10      # transactions of a customer that does not exist
REPEATED_TRANSACTION = 20
EXTREME_AMOUNT = 3        # total_amount times EXTREME
NULL_SEGMENT = 80
NULL_COUNTRY = 60
REPEATED_CUSTOMER = 30
NULL_CATEGORY = 70
REPEATED_PRODUCT = 20
MISSING_PRODUCT = 25      # products taken out of the product table
EXTREME = 50.0
ORPHAN_OFFSET = 1_000_000_000
# Multipliers of the hash: (key * A + salt * B) mod M.
A, B, M = 48271, 69621, 2147483647
# -----------------------------------------------------------------------------


def mixed(key: Column, salt: int) -> Column:
    """A number below ``M`` from an integer key; each fault has its own salt."""
    return F.pmod(F.pmod(key, F.lit(M).cast("long")) * F.lit(A).cast("long")
                  + F.lit(salt * B).cast("long"), F.lit(M).cast("long"))


def hit(key: Column, salt: int, per_thousand: int) -> Column:
    return mixed(key, salt) % 1000 < per_thousand


def _repeat(rows: DataFrame, again: Column) -> DataFrame:
    """``rows``, twice where ``again`` holds."""
    copies = F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("_copy", copies).drop("_copy")


def transaction_key(transaction_id: Column) -> Column:
    """Order and line number of an id as one integer."""
    parts = F.split(transaction_id, "-")
    return parts[0].cast("long") * 8 + parts[1].cast("long")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and unknown customers, repeated rows, extreme amounts, and a time of
    day for every transaction."""
    tx = model.transactions(spark, sf_dir)
    keyed = tx.withColumn("_key", transaction_key(F.col("transaction_id")))
    key = F.col("_key")
    faulty = keyed.withColumns({
        "customer_id": F.when(hit(key, 1, NULL_CUSTOMER), F.lit(None)).when(
            hit(key, 2, ORPHAN_CUSTOMER), F.col("customer_id") + ORPHAN_OFFSET).otherwise(F.col("customer_id")),
        "total_amount": F.when(hit(key, 3, EXTREME_AMOUNT), F.col("total_amount") * EXTREME)
                         .otherwise(F.col("total_amount")),
        "transaction_date": F.timestamp_add("SECOND", (mixed(key, 4) % 86400).cast("int"),
                                            F.col("transaction_date"))})
    return _repeat(faulty, hit(key, 5, REPEATED_TRANSACTION)).select(*tx.columns)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing segments and countries, repeated rows."""
    rows = model.customers(spark, sf_dir)
    key = F.col("customer_id")
    faulty = rows.withColumns({
        "customer_segment": F.when(~hit(key, 6, NULL_SEGMENT), F.col("customer_segment")),
        "country": F.when(~hit(key, 7, NULL_COUNTRY), F.col("country"))})
    return _repeat(faulty, hit(key, 8, REPEATED_CUSTOMER))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products taken out, missing categories, repeated rows, and a subcategory
    whose texts are all numbers."""
    rows = model.products(spark, sf_dir)
    key = F.col("product_id")
    faulty = rows.filter(~hit(key, 9, MISSING_PRODUCT)).withColumns({
        "category": F.when(~hit(key, 10, NULL_CATEGORY), F.col("category")),
        "subcategory": F.concat((key % 97).cast("string"), F.lit(".5"))})
    return _repeat(faulty, hit(key, 11, REPEATED_PRODUCT))


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three faulty star tables by name."""
    return {"transactions": transactions(spark, sf_dir), "customers": customers(spark, sf_dir),
            "products": products(spark, sf_dir)}
