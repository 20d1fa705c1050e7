"""Golden values of the garden shop in conftest.py, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import baskets, cohorts, customers, rfm, timeseries


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_enriched_columns_rows_and_profit(enriched):
    assert enriched.columns[-8:] == ["year", "month", "quarter", "day_of_week", "hour", "profit_amount",
                                     "profit_margin", "customer_tenure_days"]
    assert {"customer_segment", "country", "age_group", "category", "subcategory", "brand"} <= set(enriched.columns)
    rows = by_key(enriched, "transaction_id")
    assert sorted(rows) == [f"b{i}" for i in range(1, 8)]
    # 85 for two trees that cost 30 each; 25 of 85 is 29.4 %
    assert rows["b1"]["profit_amount"] == pytest.approx(25.0)
    assert rows["b1"]["profit_margin"] == pytest.approx(2500 / 85)
    # a Saturday evening in the fourth quarter (Sunday = 1)
    assert [rows["b5"][c] for c in ("year", "quarter", "month", "day_of_week", "hour")] == [2022, 4, 10, 7, 19]
    # 2021-11-03 to 2022-09-05
    assert rows["b1"]["customer_tenure_days"] == 306
    profit = {r["customer_id"]: r["p"] for r in
              enriched.groupBy("customer_id").agg(F.sum("profit_amount").alias("p")).collect()}
    assert profit == pytest.approx({"k01": 25.0 + 35.0 + 12.0, "k02": 10.0 + 7.0, "k03": 15.0, "k04": 10.0})


def test_customer_lifetime_and_clv(enriched):
    lt = customers.customer_lifetime(enriched)
    rows = by_key(lt, "customer_id")
    assert set(rows) == {"k01", "k02", "k03", "k04"}          # k05 never bought
    one = rows["k01"]
    assert (one["total_spent"], one["total_orders"], one["avg_order_value"]) == (177.0, 3, 59.0)
    assert (one["unique_products_purchased"], one["categories_explored"]) == (3, 2)
    # 5 September to 14 November: 70 days; 3 orders in 70 / 30 months
    assert one["customer_lifespan_days"] == 70
    assert one["purchase_frequency"] == pytest.approx(9 / 7)
    assert one["estimated_clv"] == pytest.approx(59 * 90 / 365)
    assert rows["k02"]["estimated_clv"] == pytest.approx(24 * 60 / 365)
    # one order: no lifespan, so no value yet
    assert (rows["k03"]["purchase_frequency"], rows["k03"]["estimated_clv"]) == (1.0, 0.0)
    # recency is counted from the latest purchase of all, 14 November
    assert {k: r["days_since_last_purchase"] for k, r in rows.items()} == {"k01": 0, "k02": 23, "k03": 43, "k04": 6}
    # of 0, 0, 3.95, 14.55: the 4th, 3rd and 2nd smallest
    assert customers.clv_cut_points(lt) == pytest.approx([59 * 90 / 365, 24 * 60 / 365, 0.0])
    seg = {k: v["clv_segment"] for k, v in by_key(customers.clv_segments(lt), "customer_id").items()}
    assert seg == {"k01": "Champions", "k02": "Loyal Customers", "k03": "Potential Loyalists",
                   "k04": "Potential Loyalists"}


def test_churn_bands(enriched):
    ch = by_key(customers.churn_indicators(customers.clv_segments(customers.customer_lifetime(enriched))),
                "customer_id")
    bands = {k: (r["days_since_last_purchase_risk"], r["frequency_risk"], r["engagement_risk"],
                 r["churn_risk_score"], r["churn_risk_level"]) for k, r in ch.items()}
    assert bands == {
        "k01": ("Very Low", "Medium", "Medium", 0, "Low"),
        "k02": ("Very Low", "Medium", "High", 1, "Medium"),
        "k03": ("Low", "High", "High", 3, "High"),
        "k04": ("Very Low", "High", "High", 3, "High"),
    }


def test_rfm(enriched):
    base = rfm.rfm_base(enriched)
    assert {r["customer_id"]: (r["recency"], r["frequency"], r["monetary"]) for r in base.collect()} == {
        "k01": (0, 3, 177.0), "k02": (23, 2, 48.0), "k03": (43, 1, 27.0), "k04": (6, 1, 32.0)}
    # of four values the 20th, 40th, 60th and 80th percentiles are the 1st to 4th
    q = rfm.rfm_quintiles(base).first()
    assert list(q["recency_quintiles"]) == [0, 6, 23, 43]
    assert list(q["frequency_quintiles"]) == [1, 1, 2, 3]
    assert list(q["monetary_quintiles"]) == [27.0, 32.0, 48.0, 177.0]
    seg = by_key(rfm.rfm_segments(base), "customer_id")
    assert {k: (v["rfm_score"], v["rfm_segment"]) for k, v in seg.items()} == {
        "k01": ("555", "Champions"), "k02": ("344", "Loyal Customers"), "k03": ("232", "Others"),
        "k04": ("433", "Loyal Customers")}
    assert seg["k02"]["recommended_action"] == "Upsell higher value products."
    assert seg["k03"]["recommended_action"] == "Re-engage with special offers."
    dist = {r["rfm_segment"]: r["customer_count"]
            for r in rfm.rfm_segment_distribution(rfm.rfm_segments(base)).collect()}
    assert dist == {"Champions": 1, "Loyal Customers": 2, "Others": 1}


def test_cohorts(enriched):
    rows = {(r["cohort_month"], round(r["period_number"], 8)): r for r in cohorts.cohort_retention(enriched).collect()}
    # k01 and k02 began in September; 25 September 17:05 is 20 days 8 h 45 min past the 5th 08:20
    later = [(20 * 1440 + 525) / (31 * 1440), 1 + (10 * 1440 + 465) / (31 * 1440), 2 + (9 * 1440 + 455) / (31 * 1440)]
    assert sorted(rows) == [("2022-09", 0.0), *[("2022-09", round(x, 8)) for x in later],
                            ("2022-10", 0.0), ("2022-11", 0.0)]
    first = rows["2022-09", 0.0]
    assert (first["customers_in_period"], first["revenue_in_period"], first["cohort_size"]) == (2, 115.0, 2)
    assert [rows["2022-09", round(x, 8)]["retention_rate"] for x in later] == [50.0] * 3
    assert [rows[m, 0.0]["revenue_in_period"] for m in ("2022-10", "2022-11")] == [27.0, 32.0]


def test_monthly_and_weekday_series(enriched):
    rows = {r["month"]: r for r in timeseries.monthly_series(enriched).collect()}
    assert {m: (r["monthly_revenue"], r["monthly_profit"], r["monthly_active_customers"])
            for m, r in rows.items()} == {9: (175.0, 70.0, 2), 10: (45.0, 22.0, 2), 11: (64.0, 22.0, 2)}
    assert rows[9]["mom_revenue_growth"] is None
    assert rows[10]["mom_revenue_growth"] == pytest.approx((45 - 175) / 175 * 100)
    assert rows[11]["mom_revenue_growth"] == pytest.approx((64 - 45) / 45 * 100)
    assert rows[11]["mom_customer_growth"] == 0.0
    days = {(r["month"], r["day_of_week"]): r for r in timeseries.weekday_series(enriched).collect()}
    # Mondays: 115 in September, none in October, 32 in November
    assert days[11, 2]["revenue_growth_rate"] == pytest.approx((32 - 115) / 115 * 100)
    assert days[10, 7]["revenue_growth_rate"] is None


def test_no_basket_pairs_when_every_basket_has_one_item(enriched):
    assert baskets.basket_pairs(enriched, min_support=0.0).count() == 0
    b = baskets.baskets(enriched)
    assert b.count() == 7 and b.agg(F.max("basket_size")).first()[0] == 1
