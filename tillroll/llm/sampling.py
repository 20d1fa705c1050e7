"""Bounded, repeatable samples of rows by a hash of their id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_STEPS = 1 << 20


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds`` (a null id counts as empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def sample_ids(rows: DataFrame, by: str, most: int, seed: int = 1) -> DataFrame:
    """At most ``most`` rows of each value of ``by`` (few values), chosen by a
    hash of ``doc_id``. Rows are thinned by the groups' sizes before any group
    is ranked, so a task ranks about twice ``most`` rows of a group."""
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(_STEPS))
    sizes = rows.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    thinned = (rows.join(F.broadcast(sizes), by)
               .filter(place < F.least(F.lit(1.0), F.lit(2.0 * most) / F.col("_n")
                                       + F.lit(16.0) / F.col("_n")) * _STEPS))
    rank = F.row_number().over(W.partitionBy(by).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id"))
    return thinned.select(*rows.columns, rank.alias("_rank")).filter(F.col("_rank") <= most).drop("_rank")


def one_text_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per ``keys``: of texts that repeat them, the last in order. So a
    sampled id that very many rows repeat is still one text."""
    return rows.groupBy(*keys).agg(F.max("text").alias("text"))
