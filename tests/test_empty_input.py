"""Every operator runs on an empty input (ANSI mode, empty one-row aggregates)."""

from pyspark.sql import functions as F

from conftest import SF001
from tillroll.operators import (baskets, cohorts, customers, logs, products, quality, rfm,
                                summary, timeseries)
from tillroll.operators import customers as customer_ops
from tillroll.operators import products as product_ops
from tillroll.operators.quantiles import exact_percentiles
from tillroll.sources import model


def test_operators_on_empty_input(spark):
    e = model.enriched(spark, SF001).filter(F.lit(False))
    lt = customers.customer_lifetime(e)
    outs = {
        "monthly": timeseries.monthly_series(e),
        "weekday": timeseries.weekday_series(e),
        "lifetime": lt,
        "clv": customers.clv_segments(lt),
        "clv_sketch": customers.clv_segments(lt, accuracy=100),
        "churn": customers.churn_indicators(customers.clv_segments(lt)),
        "rfm": rfm.rfm_segments(rfm.rfm_base(e)),
        "rfm_sketch": rfm.rfm_segments(rfm.rfm_base(e), accuracy=100),
        "quintiles": rfm.rfm_quintiles_long(rfm.rfm_base(e)),
        "products": products.product_performance(e),
        "top": products.top_products(e),
        "cohorts": cohorts.cohort_retention(e),
        "baskets": baskets.baskets(e),
        "pairs": baskets.basket_pairs(e, 0.0),
        "totals": summary.executive_totals(e),
        "kpis": summary.executive_summary(summary.executive_totals(e)),
        "dq": quality.quality_report(e, "empty"),
        "cleanse": quality.cleanse(e),
        "fresh": quality.freshness(e, "empty", "transaction_date", "2024-01-01 00:00:00"),
        "logs": logs.log_summary(logs.log_severity(model.logs(spark, SF001).filter(F.lit(False)))),
        "trend": logs.log_trend(logs.log_severity(model.logs(spark, SF001).filter(F.lit(False)))),
    }
    counts = {k: v.count() for k, v in outs.items()}
    assert counts["kpis"] == 4 and counts["totals"] == 1 and counts["fresh"] == 1
    assert counts["pairs"] == 0 and counts["lifetime"] == 0 and counts["cohorts"] == 0
    assert exact_percentiles(e, "total_amount", [0.5]) == [None]


def test_operators_with_null_and_orphan_keys(spark, customers, products):
    from conftest import TXN_SCHEMA, ts
    from tillroll.operators.enrich import enrich
    tx = spark.createDataFrame([
        ("T1", None, "g1", 1, 10.0, 0.0, 10.0, ts("2023-06-15 10:00:00"), "Completed"),
        ("T2", None, "g2", 1, 20.0, 0.0, 20.0, ts("2023-06-15 10:00:00"), "Completed"),
        ("T3", "k01", "gX", 2, 5.0, 0.0, 10.0, ts("2023-07-01 09:00:00"), "Completed"),
        ("T4", "k01", "g1", 1, 10.0, 0.0, 10.0, ts("2023-07-01 09:00:00"), "Completed"),
    ], TXN_SCHEMA)
    e = enrich(tx, customers, products)
    lt = customer_ops.customer_lifetime(e)
    assert {r["customer_id"] for r in lt.collect()} == {None, "k01"}
    perf = {r["product_id"]: r for r in product_ops.product_performance(e).collect()}
    assert perf["gX"]["category"] is None and perf["gX"]["category_revenue_rank"] == 1
    pairs = baskets.basket_pairs(e, 0.0).collect()
    # the null-customer basket pairs nothing (join keys never match null)
    assert [(r["product_1"], r["product_2"]) for r in pairs] == [("g1", "gX")]
    assert pairs[0]["category_2"] is None
    cohort = cohorts.cohort_retention(e).collect()
    assert sum(r["customers_in_period"] for r in cohort if r["period_number"] == 0) == 1
    for df in (rfm.rfm_segments(rfm.rfm_base(e)), timeseries.monthly_series(e),
               summary.executive_totals(e), quality.quality_report(e, "t")):
        df.collect()
