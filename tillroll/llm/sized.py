"""Broadcast hints behind a check of the size; free names; one row of repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a few 8-byte columns that may be broadcast (tens of MB when hashed).
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(written: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``written`` (a narrow table that is already on disk, so that counting
    reads file footers only) with a broadcast hint if it has at most ``limit``
    rows. Beyond that the join is left to Spark, which shuffles both sides."""
    return F.broadcast(written) if written.count() <= limit else written


def free_name(columns: list[str], base: str) -> str:
    """``base``, with underscores added until no column has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def first_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows that repeat ``keys``, the one whose columns come first as JSON
    (so reruns choose the same). Copies are aggregated before they are moved."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return (rows.groupBy(*keys).agg(F.min_by(whole, F.to_json(whole)).alias("_first"))
            .select("_first.*"))
