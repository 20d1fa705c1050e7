"""One customer holding a third of all rows: AQE splits the skewed join
partition, and results equal the unsplit plan's."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import cohorts, customers
from tillroll.operators.enrich import enrich

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def hot_star(spark):
    n = 30000
    tx = spark.range(n).select(
        F.format_string("T%06d", "id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
         .otherwise(F.format_string("C%04d", F.col("id") % 997)).alias("customer_id"),
        F.format_string("P%03d", F.col("id") % 101).alias("product_id"),
        F.lit(1).alias("quantity"),
        (F.col("id") % 50 + 1).cast("double").alias("unit_price"),
        F.lit(0.0).alias("discount_amount"),
        (F.col("id") % 50 + 1).cast("double").alias("total_amount"),
        F.timestamp_seconds(F.lit(1672531200) + (F.col("id") % 400) * 86400).alias("transaction_date"),
        F.lit("Completed").alias("status"))
    cust = spark.range(997).select(F.format_string("C%04d", "id").alias("customer_id")).union(
        spark.createDataFrame([("HOT",)], "customer_id string")).select(
        "customer_id", F.lit("seg").alias("customer_segment"), F.lit("X").alias("country"),
        F.lit("25-34").alias("age_group"), F.to_date(F.lit("2022-01-01")).alias("registration_date"))
    prod = spark.range(101).select(F.format_string("P%03d", "id").alias("product_id"),
                                   F.lit("cat").alias("category"), F.lit("sub").alias("subcategory"),
                                   F.lit("b").alias("brand"), F.lit(0.5).alias("cost"))
    return tx, cust, prod


def _run(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_customer_split_and_equal(spark, hot_star):
    tx, cust, prod = hot_star

    def lifetime():
        return sorted(tuple(r) for r in customers.customer_lifetime(
            enrich(tx, cust, prod), materialize=False).collect())

    def plan():
        df = enrich(tx, cust, prod)
        df.collect()                           # the DataFrame's own (adaptive) plan runs
        return df._jdf.queryExecution().executedPlan().toString()

    skewed = _run(spark, {**SKEW_CONF, "spark.sql.adaptive.skewJoin.enabled": "true"}, lifetime)
    plain = _run(spark, {**SKEW_CONF, "spark.sql.adaptive.skewJoin.enabled": "false"}, lifetime)
    assert skewed == plain
    hot = [r for r in skewed if r[0] == "HOT"][0]
    assert hot[4] == 10000                      # total_orders of the hot customer
    p = _run(spark, {**SKEW_CONF, "spark.sql.adaptive.skewJoin.enabled": "true"}, plan)
    assert "skew=true" in p


def test_hot_customer_cohorts_bounded_by_days(spark, hot_star):
    tx, cust, prod = hot_star
    e = enrich(tx, cust, prod)
    rows = cohorts.cohort_retention(e).collect()
    total = sum(r["revenue_in_period"] for r in rows)
    assert total == pytest.approx(tx.agg(F.sum("total_amount")).first()[0])
