"""Cohort retention: customers grouped by the month of their first purchase.

Plan: the fact is pre-aggregated once to one row per (customer, timestamp)
with an exact revenue sum and a line count (map-side combine). Everything
else runs on that smaller table, which Spark computes once and reuses: the
first purchase per customer is an aggregate of it joined back on customer_id
(not a window over each customer, which would put a hot customer's rows in
one task), and the cohort metrics re-aggregate it. Revenue and average order
value stay exact because partial sums are DECIMAL. Transactions without a
customer drop out, as an inner join drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import money_sum_exact, ratio_pct
from ..plans.durable import durable


def cohort_retention(enriched: DataFrame, whole_months: bool = False,
                     materialize: bool = True) -> DataFrame:
    """cohort_month, period_number -> customers, revenue, AOV, cohort_size,
    retention_rate (%).

    period_number is ``months_between(transaction, first purchase)``: a
    fractional month (31-day months, 8 digits) by default; ``whole_months``
    floors it to whole months.
    """
    daily = (enriched.filter(F.col("customer_id").isNotNull())
             .groupBy("customer_id", "transaction_date")
             .agg(money_sum_exact("total_amount").alias("_rev"),
                  F.count("total_amount").alias("_lines")))
    if materialize:
        daily = durable(daily, "customer_days")
    first = (daily.groupBy("customer_id")
             .agg(F.min("transaction_date").alias("first_purchase_date"))
             .withColumn("cohort_month", F.date_format("first_purchase_date", "yyyy-MM")))
    period = F.months_between(F.col("transaction_date"), F.col("first_purchase_date"))
    if whole_months:
        period = F.floor(period).cast("double")
    data = daily.join(first, "customer_id", "inner").withColumn("period_number", period)
    revenue = F.sum("_rev").cast("double")
    metrics = data.groupBy("cohort_month", "period_number").agg(
        F.count_distinct("customer_id").alias("customers_in_period"),
        revenue.alias("revenue_in_period"),
        F.try_divide(revenue, F.sum("_lines").cast("double")).alias("avg_order_value_in_period"),
    )
    # Every customer has a transaction in period 0, so a cohort's size is its
    # number of customers; the metrics are not computed twice.
    sizes = first.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return (metrics.join(sizes, "cohort_month", "inner")
            .withColumn("retention_rate",
                        ratio_pct(F.col("customers_in_period"), F.col("cohort_size"))))
