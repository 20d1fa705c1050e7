"""RFM analysis: recency / frequency / monetary, quintile scores, segments.

Plan: one per-customer aggregation (written once); the global max date and
the twelve quintile cut points come from aggregates over that small table and
are used as literals (no join). The cut points are exact, found by counting
(``quantiles``), so no task ever orders or holds all customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exprs import lit_value, money_sum, one_row
from ..plans.durable import durable
from .quantiles import exact_percentiles_of

QUINTILES = [0.2, 0.4, 0.6, 0.8]
DIMENSIONS = ("recency", "frequency", "monetary")


def rfm_base(enriched: DataFrame, materialize: bool = True) -> DataFrame:
    """customer_id -> recency (days before the latest transaction in the data),
    frequency (transactions) and monetary (total spend).

    The per-customer aggregate feeds the global latest date and the rows; by
    default it is written once (``durable``) so the fact is read once."""
    per_customer = enriched.groupBy("customer_id").agg(
        F.max("transaction_date").alias("_last"),
        F.count("transaction_id").alias("frequency"),
        money_sum("total_amount").alias("monetary"),
    )
    if materialize:
        per_customer = durable(per_customer, "rfm_customers")
    # Latest date overall = max of the per-customer maxima (no second fact scan),
    # made a date inside Spark, so no other time zone touches it.
    latest = lit_value(one_row(per_customer.select(F.to_date(F.max("_last"))))[0])
    return per_customer.select(
        "customer_id",
        F.datediff(latest, F.col("_last")).alias("recency"),
        "frequency", "monetary",
    )


def rfm_quintiles(base: DataFrame, accuracy: int | None = None) -> DataFrame:
    """One row: <dim>_quintiles = [p20, p40, p60, p80] per dimension, exact
    discrete percentiles. An ``accuracy`` asks for the mergeable sketch instead,
    whose cut points may sit a few ranks off on large inputs."""
    if accuracy is not None:
        return base.agg(*[F.percentile_approx(d, QUINTILES, accuracy).alias(f"{d}_quintiles")
                          for d in DIMENSIONS])
    cuts = exact_percentiles_of(base, dict.fromkeys(DIMENSIONS, QUINTILES))
    kinds = dict(base.dtypes)
    return base.sparkSession.range(1).select(
        *[lit_value(cuts[d]).cast(f"array<{kinds[d]}>").alias(f"{d}_quintiles") for d in DIMENSIONS])


def rfm_quintiles_long(base: DataFrame, accuracy: int | None = None) -> DataFrame:
    """The cut points in long form: (dimension, quantile, cut_point)."""
    q = rfm_quintiles(base, accuracy)
    rows = []
    for d in DIMENSIONS:
        for i, p in enumerate(QUINTILES):
            rows.append(F.struct(F.lit(d).alias("dimension"), F.lit(p).alias("quantile"),
                                 F.col(f"{d}_quintiles")[i].cast("double").alias("cut_point")))
    return q.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def rfm_segments(base: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Scores 1-5, segment, rfm_score string and recommended action, by the cut
    points of ``rfm_quintiles``."""
    row = one_row(rfm_quintiles(base, accuracy))
    # no customers: no cut points, which scores every row 1
    q = {d: lit_value(row[f"{d}_quintiles"] or [None] * len(QUINTILES)) for d in DIMENSIONS}
    scored = base.withColumns({
        "r_score": rules.score_low_is_good(F.col("recency"), q["recency"]),
        "f_score": rules.score_high_is_good(F.col("frequency"), q["frequency"]),
        "m_score": rules.score_high_is_good(F.col("monetary"), q["monetary"]),
    })
    seg = scored.withColumn("rfm_segment", rules.rfm_segment(F.col("r_score"), F.col("f_score"),
                                                             F.col("m_score")))
    seg = seg.withColumn("rfm_score", F.concat(F.col("r_score").cast("string"),
                                               F.col("f_score").cast("string"),
                                               F.col("m_score").cast("string")))
    return seg.withColumn("recommended_action", rules.rfm_action(F.col("rfm_segment")))


def rfm_segment_distribution(segments: DataFrame) -> DataFrame:
    """rfm_segment -> customer_count."""
    return segments.groupBy("rfm_segment").agg(F.count("*").alias("customer_count"))
