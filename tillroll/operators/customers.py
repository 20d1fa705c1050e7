"""Customer lifetime value, CLV segments and churn indicators.

The per-customer table is made of hash aggregations (partial on the map side, so
a customer holding a large share of rows is collapsed before the shuffle): the
sums, and for each distinct count the distinct (customer, item) pairs, spread by
item. In one aggregation Catalyst would make three rows of each, and sort them
all because of the text attributes.
Global values (the as-of date, CLV cut points) are one-row aggregates over the
small per-customer table, read once (a few scalars) and used as literals: one
cheap job each, then a plan without joins.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exprs import lit_value, money_of, money_parts, one_row
from ..plans.durable import durable
from .quantiles import exact_percentiles

ATTRIBUTES = ("customer_segment", "country", "age_group")


def _as_of(per_customer: DataFrame, as_of):
    """The as-of date as a Column. The default, the latest transaction, is the
    max over the per-customer table (the fact is not re-read), made a date
    inside Spark, so no other time zone touches it."""
    if as_of is None:
        return lit_value(one_row(per_customer.select(F.to_date(F.max("last_purchase_date"))))[0])
    if isinstance(as_of, (_dt.date, _dt.datetime, str)):
        return F.lit(as_of)
    raise TypeError("as_of must be None, a date/datetime or an ISO string")


def _per_customer(enriched: DataFrame, attributes: tuple[str, ...]) -> DataFrame:
    """The totals of every customer_id (null included). Attributes are keys of the
    sums and reduced to the greatest when there is about one row per customer."""
    amount, profit = money_parts("total_amount"), money_parts("profit_amount")
    sums = enriched.groupBy("customer_id", *attributes).agg(
        F.sum(amount[0]).alias("_spent"), F.sum(amount[1]).alias("_spent_micros"),
        F.count(amount[0]).alias("_amounts"),
        F.sum(profit[0]).alias("_profit"), F.sum(profit[1]).alias("_profit_micros"),
        F.count("transaction_id").alias("_orders"),
        F.max("transaction_date").alias("_last"), F.min("transaction_date").alias("_first"))

    def distinct_items(column: str, name: str) -> DataFrame:
        pairs = enriched.filter(F.col(column).isNotNull()).select("customer_id", column).distinct()
        return pairs.groupBy("customer_id").agg(F.count(F.lit(1)).alias(name))

    parts = (sums.unionByName(distinct_items("product_id", "_products"), allowMissingColumns=True)
             .unionByName(distinct_items("category", "_categories"), allowMissingColumns=True))

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0).cast("long"))

    spent = money_of(F.sum("_spent"), F.sum("_spent_micros")).cast("double")
    return parts.groupBy("customer_id").agg(
        spent.alias("total_spent"),
        F.try_divide(spent, total("_amounts").cast("double")).alias("avg_order_value"),
        money_of(F.sum("_profit"), F.sum("_profit_micros")).cast("double").alias("total_profit_generated"),
        total("_orders").alias("total_orders"),
        total("_products").alias("unique_products_purchased"),
        total("_categories").alias("categories_explored"),
        F.max("_last").alias("last_purchase_date"),
        F.min("_first").alias("first_purchase_date"),
        *[F.max(a).alias(a) for a in attributes])


def customer_lifetime(enriched: DataFrame, as_of=None,
                      attributes: tuple[str, ...] = ATTRIBUTES,
                      materialize: bool = True) -> DataFrame:
    """customer_id -> spend, orders, breadth, recency and estimated CLV.

    ``as_of`` is the date recency is measured from; by default the latest
    transaction date in the data, so results do not change from day to day.

    One row per customer_id: an attribute is the greatest value among the
    customer's rows, so a key that the dimension repeats with other attributes
    does not split its totals.

    The per-customer table feeds both the as-of date and the rows, so by
    default it is written once to the shared checkpoint folder (``durable``)
    rather than computed twice from the fact table.
    """
    per_customer = _per_customer(enriched, attributes)
    if materialize:
        per_customer = durable(per_customer, "customer_lifetime")
    lifespan = F.datediff(F.col("last_purchase_date"), F.col("first_purchase_date"))
    out = per_customer.withColumns({
        "days_since_last_purchase": F.datediff(_as_of(per_customer, as_of),
                                               F.col("last_purchase_date")),
        "customer_lifespan_days": lifespan,
    })
    frequency = F.when(F.col("customer_lifespan_days") > 0,
                       F.col("total_orders") / (F.col("customer_lifespan_days") / F.lit(30.0))
                       ).otherwise(F.col("total_orders").cast("double"))
    out = out.withColumn("purchase_frequency", frequency)
    return out.withColumn(
        "estimated_clv",
        F.col("avg_order_value") * F.col("purchase_frequency")
        * (F.col("customer_lifespan_days") / F.lit(365.0)),
    )


def clv_cut_points(lifetime: DataFrame, accuracy: int | None = None) -> list:
    """p80, p60, p40 of estimated_clv: exact discrete percentiles, or with an
    ``accuracy`` those of the mergeable sketch."""
    probs = [0.8, 0.6, 0.4]
    if accuracy is None:
        return exact_percentiles(lifetime, "estimated_clv", probs)
    return one_row(lifetime.agg(F.percentile_approx("estimated_clv", probs, accuracy)))[0] or [None] * 3


def clv_segments(lifetime: DataFrame, accuracy: int | None = None, materialize: bool = False) -> DataFrame:
    """Add clv_segment from global CLV percentiles (Champions ... New Customers).

    The lifetime table feeds both the cut points and the scored rows. From
    ``customer_lifetime`` it already reads a durable per-customer table, so
    both branches re-read those files; pass ``materialize=True`` for a
    lifetime table that is still an unmaterialized plan."""
    if materialize:
        lifetime = durable(lifetime, "customer_lifetime")
    p80, p60, p40 = clv_cut_points(lifetime, accuracy)
    seg = rules.clv_segment(F.col("estimated_clv"), lit_value(p80), lit_value(p60),
                            lit_value(p40))
    return lifetime.withColumn("clv_segment", seg)


def churn_indicators(customer_metrics: DataFrame) -> DataFrame:
    """Recency, frequency and engagement risk bands, a 0-6 score, a level and
    an intervention. Pure projection: no shuffle."""
    days = rules.recency_risk(F.col("days_since_last_purchase"))
    freq = rules.frequency_risk(F.col("total_orders"))
    eng = rules.engagement_risk(F.col("categories_explored"))
    out = customer_metrics.withColumns({
        "days_since_last_purchase_risk": days,
        "frequency_risk": freq,
        "engagement_risk": eng,
    })
    score = (F.when(F.col("days_since_last_purchase_risk") == "High", 3).otherwise(0)
             + F.when(F.col("frequency_risk") == "High", 2).otherwise(0)
             + F.when(F.col("engagement_risk") == "High", 1).otherwise(0))
    out = out.withColumn("churn_risk_score", score)
    out = out.withColumn("churn_risk_level", rules.churn_level(F.col("churn_risk_score")))
    return out.withColumn("recommended_intervention",
                          rules.churn_intervention(F.col("churn_risk_level")))
