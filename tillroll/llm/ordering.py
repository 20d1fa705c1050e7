"""Row numbers inside groups of any size, by a range sort.

A window over a group would put the whole group in one task. Rows are range
partitioned by group and order instead, so a group spreads over as many
partitions as it fills; the number of rows of the group in earlier partitions is
added to a row's place in its own partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable


def same_group(left: str, right: str, by: list[str]):
    """Null-safe equality of the columns ``by`` of two aliased tables."""
    on = F.lit(True)
    for c in by:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str,
             number_groups: bool = False) -> DataFrame:
    """``rows`` (a written table) with ``pos`` (from 0, in its group ``by``, by
    ``order``, ascending, nulls first), ``group_rows`` and, if asked for,
    ``group_no`` (from 0, the group's place among the groups in ascending order,
    nulls first).

    ``order`` should tell equal rows apart (a row tag comes last), else rows that
    are equal in all of it cannot be spread over partitions.
    """
    keys = by + order
    placed = durable(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                     .withColumn("_at", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftright("_at", 33).alias("_part")
    spans = placed.groupBy(part, *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    group = W.partitionBy(*by)
    earlier = group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    spans = durable(spans.select(
        "*", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("group_rows")), f"{name}-spans")
    if number_groups:
        groups = durable(spans.filter("_before = 0").select(*by), f"{name}-groups")
        numbers = numbered(groups, [], by, f"{name}-groups").select(*by, F.col("pos").alias("group_no"))
        s, g = spans.alias("s"), numbers.alias("g")
        spans = durable(s.join(g, same_group("s", "g", by)).select("s.*", "g.group_no"), f"{name}-spans")
    r, s = placed.withColumn("_part", part).alias("r"), spans.alias("s")
    return (r.join(s, (F.col("r._part") == F.col("s._part")) & same_group("r", "s", by))
            .select(*[F.col(f"r.{c}") for c in rows.columns],
                    (F.col("r._at") - F.col("s._first") + F.col("s._before")).alias("pos"),
                    F.col("s.group_rows"), *([F.col("s.group_no")] if number_groups else [])))
