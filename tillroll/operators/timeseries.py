"""Calendar rollups with period-over-period growth.

Both aggregates are partial/final hash aggregations over the enriched table
(map-side combine, so a hot month costs one row per map task). The growth
windows then run over the tiny aggregated tables (one row per month, or per
month and weekday), so their single or seven-way window partitions are
bounded by the calendar, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import money_avg, money_sum, pct_change


def monthly_series(enriched: DataFrame) -> DataFrame:
    """year, month -> revenue, profit, transactions, active customers, products,
    with month-over-month revenue and customer growth in percent."""
    m = enriched.groupBy("year", "month").agg(
        money_sum("total_amount").alias("monthly_revenue"),
        money_sum("profit_amount").alias("monthly_profit"),
        F.count("transaction_id").alias("monthly_transactions"),
        F.count_distinct("customer_id").alias("monthly_active_customers"),
        F.count_distinct("product_id").alias("monthly_products_sold"),
    )
    # One row per calendar month: a global window is bounded by the calendar.
    w = Window.orderBy("year", "month")
    return m.withColumns({
        "mom_revenue_growth": pct_change(F.col("monthly_revenue"),
                                         F.lag("monthly_revenue", 1).over(w)),
        "mom_customer_growth": pct_change(F.col("monthly_active_customers").cast("double"),
                                          F.lag("monthly_active_customers", 1).over(w)),
    })


def weekday_series(enriched: DataFrame) -> DataFrame:
    """year, month, day_of_week -> revenue, profit, transactions, customers, AOV,
    with growth against the same weekday of the previous month present."""
    d = enriched.groupBy("year", "month", "day_of_week").agg(
        money_sum("total_amount").alias("daily_revenue"),
        money_sum("profit_amount").alias("daily_profit"),
        F.count("transaction_id").alias("daily_transactions"),
        F.count_distinct("customer_id").alias("daily_unique_customers"),
        money_avg("total_amount").alias("daily_avg_order_value"),
    )
    w = Window.partitionBy("day_of_week").orderBy("year", "month")
    return d.withColumn("revenue_growth_rate",
                        pct_change(F.col("daily_revenue"), F.lag("daily_revenue", 1).over(w)))
