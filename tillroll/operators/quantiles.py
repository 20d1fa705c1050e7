"""Exact discrete percentiles by counting.

``exact_percentiles`` returns the values at ranks ``max(1, ceil(p * n))`` (SQL
``percentile_disc`` / ``quantile_disc``). Each round is one aggregation for all
columns and probabilities together: every probe splits its current value range
into equal buckets, Spark counts each bucket and keeps its least and greatest
value, and the bucket that holds the rank becomes the next range. A probe ends
when its range is one value. The ends of a range have buckets of their own, so
every round narrows it; doubles need a handful of rounds.

Nothing is ordered and no values are gathered. The driver reads at most
``buckets`` + 2 counts per probe and round.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(x: Column, low, high, buckets: int) -> Column:
    """0 and ``buckets`` + 1 for the ends of the range, between them by value."""
    width = F.lit(float(high)) / 2 - F.lit(float(low)) / 2
    share = F.try_divide(x.cast("double") / 2 - F.lit(float(low)) / 2, width)
    inner = F.least(F.lit(buckets - 1), F.floor(F.coalesce(share, F.lit(0.0)) * buckets).cast("int")) + 1
    return F.when(x == F.lit(low), 0).when(x == F.lit(high), buckets + 1).otherwise(inner)


def exact_percentiles_of(df: DataFrame, wanted: Mapping[str, Sequence[float]],
                         buckets: int = 256) -> dict[str, list]:
    """Exact discrete percentiles of several columns, by column one value per
    probability. Nulls, NaN and infinite values are left out; a column without
    values gives nulls."""
    columns = list(wanted)

    def value(c: str) -> Column:
        x = F.col(c)
        return F.when(F.abs(x.cast("double")) < F.lit(math.inf), x)      # not null, NaN or infinite

    values = df.select(*[value(c).alias(f"v{i}") for i, c in enumerate(columns)])
    ends = values.agg(*[f(f"v{i}").alias(f"{n}{i}") for i in range(len(columns))
                        for n, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
    # probe: [column, rank inside the range, low, high]
    probes = {(i, j): [i, max(1, math.ceil(p * ends[f"n{i}"])), ends[f"low{i}"], ends[f"high{i}"]]
              for i, c in enumerate(columns) for j, p in enumerate(wanted[c])}
    while open_ranges := sorted({(p[0], p[2], p[3]) for p in probes.values() if p[2] != p[3]}):
        parts = [F.when(F.col(f"v{i}").between(F.lit(low), F.lit(high)), F.struct(
            F.lit(r).alias("range"), _bucket(F.col(f"v{i}"), low, high, buckets).alias("bucket"),
            *[(F.col(f"v{k}") if k == i else F.lit(None).cast(values.schema[f"v{k}"].dataType)).alias(f"x{k}")
              for k in range(len(columns))])) for r, (i, low, high) in enumerate(open_ranges)]
        counted = (values.select(F.explode(F.array_compact(F.array(*parts))).alias("p")).select("p.*")
                   .groupBy("range", "bucket")
                   .agg(F.count(F.lit(1)).alias("n"), *[f(f"x{k}").alias(f"{name}{k}")
                        for k in range(len(columns)) for name, f in (("low", F.min), ("high", F.max))])
                   .collect())
        by_range: dict[int, list] = {}
        for row in sorted(counted, key=lambda r: (r["range"], r["bucket"])):
            by_range.setdefault(row["range"], []).append(row)
        for probe in probes.values():
            i, rank, low, high = probe
            if low == high:
                continue
            for row in by_range[open_ranges.index((i, low, high))]:
                if rank <= row["n"]:
                    probe[1:] = rank, row[f"low{i}"], row[f"high{i}"]
                    break
                rank -= row["n"]
    return {c: [probes[i, j][2] for j in range(len(wanted[c]))] for i, c in enumerate(columns)}


def exact_percentiles(df: DataFrame, column: str, probs: Sequence[float], buckets: int = 256) -> list:
    """``exact_percentiles_of`` for one column."""
    return exact_percentiles_of(df, {column: probs}, buckets)[column]
