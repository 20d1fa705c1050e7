"""Executive KPIs: whole-table totals and their long-form KPI table.

The KPI table is an unpivot (``stack``) of the one-row totals aggregate, so it
stays a lazy plan instead of collected values turned back into rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import money_avg, money_sum

# FIXED VALUES: KPI rows (name, source column, type), in published order.
KPIS = [
    ("Total Revenue", "total_revenue", "currency"),
    ("Total Profit", "total_profit", "currency"),
    ("Active Customers", "active_customers", "count"),
    ("Average Order Value", "avg_order_value", "currency"),
]


def executive_totals(enriched: DataFrame) -> DataFrame:
    """One row: revenue, profit, transactions, active customers, products, AOV."""
    return enriched.agg(
        money_sum("total_amount").alias("total_revenue"),
        money_sum("profit_amount").alias("total_profit"),
        F.count("transaction_id").alias("total_transactions"),
        F.count_distinct("customer_id").alias("active_customers"),
        F.count_distinct("product_id").alias("products_sold"),
        money_avg("total_amount").alias("avg_order_value"),
    )


def executive_summary(totals: DataFrame) -> DataFrame:
    """Four KPI rows: metric_name, metric_value (double), metric_type."""
    rows = [F.struct(F.lit(name).alias("metric_name"),
                     F.col(src).cast("double").alias("metric_value"),
                     F.lit(kind).alias("metric_type")) for name, src, kind in KPIS]
    return totals.select(F.explode(F.array(*rows)).alias("k")).select("k.*")
