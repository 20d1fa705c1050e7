"""Product performance, in-category revenue rank, and the top-k report.

The in-category rank is exact but never puts a whole category in one task:
products are range partitioned by (category, revenue descending, id), and the
number of the category's rows in earlier partitions is added to a row's place in
its own. A window partitioned by category alone would give each category's
products to a single task, and a category can hold a large share of the catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import free_name, money_avg, money_sum
from ..plans.durable import durable

TOP_PERFORMER_RANK = 5


def product_metrics(enriched: DataFrame) -> DataFrame:
    """product_id, category, subcategory, brand -> units, revenue, profit,
    transactions, customers, averages and per-customer / per-transaction ratios."""
    m = enriched.groupBy("product_id", "category", "subcategory", "brand").agg(
        F.sum("quantity").alias("total_units_sold"),
        money_sum("total_amount").alias("total_revenue"),
        money_sum("profit_amount").alias("total_profit"),
        F.count("transaction_id").alias("total_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        money_avg("total_amount").alias("avg_transaction_value"),
        money_avg("profit_margin").alias("avg_profit_margin"),
    )
    return m.withColumns({
        "revenue_per_customer": F.try_divide(F.col("total_revenue"), F.col("unique_customers")),
        "units_per_transaction": F.try_divide(F.col("total_units_sold").cast("double"),
                                              F.col("total_transactions")),
    })


def rank_desc_within(df: DataFrame, group: str, value: str, tie: str, out: str) -> DataFrame:
    """Exact ``row_number() over (partition by group order by value desc, tie)``,
    nulls last, spread over as many tasks as the data fills.

    Rows are range partitioned and sorted by (group, value desc, tie) and written
    once (two range sorts of one input may choose other cut points, and the counts
    have to fit the rows). The write numbers the rows of each partition; a count
    table with one row per partition and group gives what lies before. A value
    that a third of the rows share is spread by the tie. Columns may be of any
    orderable type. Null groups are a group.
    """
    order = [F.col(group), F.col(value).desc_nulls_last(), F.col(tie).asc_nulls_last()]
    at, part = free_name(df, "_at"), free_name(df, "_part")
    placed = durable(df.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn(at, F.monotonically_increasing_id()), "rank_order")
    placed = placed.withColumn(part, F.shiftright(at, 33))
    counts = placed.groupBy(part, group).agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_first"))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(part, group, (F.coalesce(F.sum("_n").over(earlier), F.lit(0))
                                         - F.col("_first") + 1).alias("_shift"))
    p, b = placed.alias("p"), before.alias("b")
    return p.join(b, (F.col(f"p.{part}") == F.col(f"b.{part}"))
                  & F.col(f"p.{group}").eqNullSafe(F.col(f"b.{group}"))).select(
        *[F.col(f"p.{c}") for c in df.columns], (F.col(f"p.{at}") + F.col("b._shift")).cast("int").alias(out))


def product_performance(enriched: DataFrame, top_n: int = TOP_PERFORMER_RANK) -> DataFrame:
    """Product metrics plus category_revenue_rank (ties broken by product_id)
    and is_top_performer (rank <= top_n)."""
    ranked = rank_desc_within(product_metrics(enriched), "category", "total_revenue",
                              "product_id", "category_revenue_rank")
    return ranked.withColumn("is_top_performer", F.col("category_revenue_rank") <= top_n)


def top_products(enriched: DataFrame, k: int = 10) -> DataFrame:
    """Top-k (product_id, category) by revenue: a bounded TakeOrderedAndProject."""
    rev = enriched.groupBy("product_id", "category").agg(money_sum("total_amount").alias("revenue"))
    return rev.orderBy(F.col("revenue").desc(), F.col("product_id").asc()).limit(k)
