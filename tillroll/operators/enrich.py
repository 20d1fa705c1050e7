"""The enriched transaction table: completed sales with customer, product and
calendar context plus per-line profit. Input to almost every metric.

Plan shape: the status filter is applied first (pushed to the orders scan by
Catalyst), then two left equi joins. No broadcast hint: dimension size grows
with the data, so AQE picks a broadcast hash join from runtime sizes when a
dimension is small and a sort-merge join (with skew splitting) when it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import COMPLETED

CUSTOMER_ATTRS = ("customer_segment", "country", "age_group", "registration_date")
PRODUCT_ATTRS = ("category", "subcategory", "brand", "cost")


def enrich(transactions: DataFrame, customers: DataFrame, products: DataFrame,
           customer_attrs: tuple[str, ...] = CUSTOMER_ATTRS,
           product_attrs: tuple[str, ...] = PRODUCT_ATTRS) -> DataFrame:
    """Completed transactions + customer and product attributes + derived columns.

    Left joins keep transactions whose customer or product is unknown (their
    attributes are null). ``customer_attrs`` lets a caller whose customer table
    lacks an attribute (e.g. no ``age_group``) leave it out.
    """
    fact = transactions.filter(F.col("status") == F.lit(COMPLETED))
    cust = customers.select("customer_id", *customer_attrs)
    prod = products.select("product_id", *product_attrs)
    j = fact.join(cust, "customer_id", "left").join(prod, "product_id", "left")
    return derive(j, list(transactions.columns), customer_attrs, product_attrs)


def derive(j: DataFrame, transaction_cols: list[str],
           customer_attrs: tuple[str, ...] = CUSTOMER_ATTRS,
           product_attrs: tuple[str, ...] = PRODUCT_ATTRS) -> DataFrame:
    """Calendar parts, profit, margin and tenure on joined rows; natural order."""
    ts = F.col("transaction_date")
    profit = F.col("total_amount") - F.col("quantity") * F.col("cost")
    derived = {
        "year": F.year(ts),
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "day_of_week": F.dayofweek(ts),
        "hour": F.hour(ts),
        "profit_amount": profit,
        "profit_margin": F.when(F.col("total_amount") > 0,
                                profit / F.col("total_amount") * F.lit(100.0))
                          .otherwise(F.lit(0.0)),
    }
    if "registration_date" in customer_attrs:
        derived["customer_tenure_days"] = F.datediff(ts, F.col("registration_date"))
    out = j.withColumns(derived)
    # Restore the natural column order: transaction, customer, product, derived.
    order = list(transaction_cols) + list(customer_attrs) + list(product_attrs) + list(derived)
    return out.select(*order)
