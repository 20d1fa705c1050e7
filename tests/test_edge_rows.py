"""Rows no reference test covers (FIXTURES.md section 5) and brute-force checks
of the two operators built from several Spark steps (rank, pairs)."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import CUSTOMER_SCHEMA, PRODUCT_SCHEMA, TXN_SCHEMA, d, ts
from tillroll.operators import baskets, cohorts, logs, products, summary, timeseries
from tillroll.operators.enrich import enrich


@pytest.fixture(scope="module")
def star(spark):
    cust = spark.createDataFrame([
        ("C1", "A", "B", "a@x", d("2023-01-01"), "Premium", "USA", "25-34"),
        ("C2", "C", "D", "c@x", d("2023-01-01"), "Basic", None, "35-44"),
    ], CUSTOMER_SCHEMA)
    prod = spark.createDataFrame([
        ("P1", "n1", "Cat", "s", "B1", 10.0, 6.0),
        ("P2", "n2", "Cat", "s", "B2", 10.0, 6.0),
        ("P3", "n3", "Cat", "s", "B1", 5.0, 2.0),
    ], PRODUCT_SCHEMA)
    t1 = ts("2023-01-31 10:00:00")
    tx = spark.createDataFrame([
        # one basket (C1, t1): P1, P2 and P1 again
        ("T1", "C1", "P1", 1, 10.0, 0.0, 10.0, t1, "Completed"),
        ("T2", "C1", "P2", 1, 10.0, 0.0, 10.0, t1, "Completed"),
        ("T3", "C1", "P1", 1, 10.0, 0.0, 10.0, t1, "Completed"),
        # month-end to month-end: a whole number of months
        ("T4", "C1", "P3", 1, 5.0, 0.0, 5.0, ts("2023-02-28 10:00:00"), "Completed"),
        # no March sales; April follows (growth against February)
        ("T5", "C1", "P3", 1, 5.0, 0.0, 5.0, ts("2023-04-30 09:00:00"), "Completed"),
        # orphan customer and orphan product
        ("T6", "C9", "P9", 2, 7.0, 0.0, 14.0, ts("2023-02-15 00:00:00"), "Completed"),
        # not completed: dropped by enrichment
        ("T7", "C2", "P1", 1, 10.0, 0.0, 10.0, ts("2023-02-15 00:00:00"), "Pending"),
        ("T8", "C2", "P2", 1, 10.0, 0.0, 10.0, ts("2023-01-15 00:00:00"), "Completed"),
    ], TXN_SCHEMA)
    return tx, cust, prod


def test_status_filter_and_orphans_kept(star):
    tx, cust, prod = star
    e = enrich(tx, cust, prod)
    ids = {r["transaction_id"]: r for r in e.collect()}
    assert "T7" not in ids and len(ids) == 7
    assert ids["T6"]["customer_segment"] is None and ids["T6"]["category"] is None
    # unknown cost: profit is null, and so is the margin (total > 0 picks the ratio)
    assert ids["T6"]["profit_amount"] is None and ids["T6"]["profit_margin"] is None


def test_basket_pairs_count_duplicates(star):
    tx, cust, prod = star
    e = enrich(tx, cust, prod)
    pairs = baskets.basket_pairs(e, min_support=0.0).collect()
    assert [(r["product_1"], r["product_2"], r["pair_count"]) for r in pairs] == [("P1", "P2", 2)]
    total_baskets = e.select("customer_id", "transaction_date").distinct().count()
    assert pairs[0]["support"] == pytest.approx(2 / total_baskets)
    assert (pairs[0]["brand_1"], pairs[0]["brand_2"]) == ("B1", "B2")
    once = baskets.basket_pairs(e, min_support=0.0, distinct_items=True).collect()
    assert once[0]["pair_count"] == 1
    items = {(r["item"], r["item_count"]) for r in baskets.basket_items(e).collect()
             if r["customer_id"] == "C1" and r["transaction_date"].day == 31}
    assert items == {("P1", 2), ("P2", 1)}


def test_whole_month_periods_and_growth_gap(star):
    tx, cust, prod = star
    e = enrich(tx, cust, prod)
    periods = {(r["cohort_month"], r["period_number"]) for r in cohorts.cohort_retention(e).collect()}
    assert ("2023-01", 1.0) in periods                 # Jan 31 -> Feb 28: both month ends
    m = {(r["year"], r["month"]): r for r in timeseries.monthly_series(e).collect()}
    assert (2023, 3) not in m
    assert m[(2023, 4)]["mom_revenue_growth"] == pytest.approx((5 - 19) / 19 * 100)


def test_equal_revenue_tie_broken_by_product_id(star):
    tx, cust, prod = star
    e = enrich(tx, cust, prod).filter(F.col("transaction_id").isin("T2", "T8", "T4"))
    ranks = {r["product_id"]: r["category_revenue_rank"]
             for r in products.product_performance(e).collect()}
    assert ranks == {"P2": 1, "P3": 2}
    top = summary.executive_summary(summary.executive_totals(e)).collect()
    assert [r["metric_name"] for r in top] == ["Total Revenue", "Total Profit", "Active Customers",
                                                "Average Order Value"]


@pytest.mark.parametrize("seed", [1, 2])
def test_bucketed_rank_equals_window_rank(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"c{rnd.randint(0, 3)}", i, float(rnd.choice([0, 1, 2, 5, 5, 7, 100, rnd.random()])))
            for i in range(3000)]
    rows += [(None, 5000 + i, float(i % 3)) for i in range(20)] + [("c1", 9000, None)]
    df = spark.createDataFrame(rows, "g string, id int, v double")
    got = products.rank_desc_within(df, "g", "v", "id", "r")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), F.col("id").asc())
    want = df.withColumn("r", F.row_number().over(w))
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())


def test_basket_pairs_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for b in range(300):
        size = rnd.choice([1, 1, 2, 3, 5, 8])
        for j in range(size):
            rows.append((f"cust{b % 40}", b, f"p{rnd.randint(0, 12)}", float(j)))
    df = spark.createDataFrame(rows, "customer_id string, b int, product_id string, total_amount double")
    df = (df.withColumn("transaction_date", F.timestamp_seconds(F.col("b") * 86400))
          .withColumn("category", F.lit("c")).withColumn("brand", F.lit("x")))
    baskets_ = {}
    for c, b, p, _ in rows:
        baskets_.setdefault((c, b), []).append(p)
    total = len(baskets_)
    counts = Counter()
    for items in baskets_.values():
        for a, bb in itertools.combinations(items, 2):
            if a != bb:
                counts[tuple(sorted((a, bb)))] += 1
    for min_support in (0.0, 0.01, 0.03):
        want = {k: v for k, v in counts.items() if v / total >= min_support}
        got = {(r["product_1"], r["product_2"]): r["pair_count"]
               for r in baskets.basket_pairs(df, min_support).collect()}
        assert got == want


def test_log_classification_tiers(spark):
    msgs = [("OutOfMemoryError", "Java heap space exhausted"),
            ("ClientError", "S3 bucket unreachable"),
            ("ValueError", "schema mismatch in input"),
            ("X", "all good"),
            ("Y", "Out of memory during data quality scan"),      # two tiers: first wins
            ("ConnectionError", "Read timeout on host")]
    df = spark.createDataFrame(
        [(i, ts("2024-01-01 00:00:00"), "c", t, m) for i, (t, m) in enumerate(msgs)],
        "error_id long, timestamp timestamp, component string, error_type string, error_message string")
    c = {r["error_id"]: r for r in logs.log_severity(df).collect()}
    assert [c[i]["severity"] for i in range(6)] == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "CRITICAL", "LOW"]
    assert [c[i]["recovery_route"] for i in range(6)] == [
        None, "s3_access_error", None, None, "memory_error", "network_timeout"]
    assert c[0]["suggestions"].startswith("Increase Spark executor memory")
    assert c[3]["suggestions"] == "Contact system administrator"
    alerts = {r["error_id"] for r in logs.log_alerts(logs.log_severity(df)).collect()}
    assert alerts == {0, 2, 3, 4}


def test_rank_splits_a_heavily_tied_value(spark):
    # a third of the group shares one value: still exact, and no rank task
    # (group, bucket, sub-bucket) holds more than a small share of the group
    n = 9000
    rows = [("g", i, 7.0 if i % 3 == 0 else float(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    got = products.rank_desc_within(df, "g", "v", "id", "r")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), F.col("id").asc())
    want = df.withColumn("r", F.row_number().over(w))
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())
    # the heavy value is spread over range partitions by the tie
    order = [F.col("g"), F.col("v").desc_nulls_last(), F.col("id").asc()]
    parts = df.repartitionByRange(16, *order).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 12 and max(r["count"] for r in parts) <= n / 8


@pytest.mark.parametrize("block_items", [2, 4, 512])
def test_basket_pairs_big_baskets_in_blocks(spark, block_items):
    # one hot basket holding a third of the rows plus many small ones; small
    # block_items cuts them into many blocks
    rnd = random.Random(11)
    rows = [("hot", 0, f"p{i % 15}", 1.0) for i in range(300)]
    for b in range(1, 300):
        for _ in range(rnd.choice([1, 2, 3, 4, 6])):
            rows.append((f"c{b % 50}", b, f"p{rnd.randint(0, 14)}", 1.0))
    for b in range(300, 304):                     # a few more big baskets
        for i in range(8):
            rows.append(("big", b, f"p{(i * 3 + b) % 15}", 1.0))
    df = spark.createDataFrame(rows, "customer_id string, b int, product_id string, total_amount double")
    df = (df.withColumn("transaction_date", F.timestamp_seconds(F.col("b") * 86400))
          .withColumn("category", F.lit("c")).withColumn("brand", F.lit("x")))
    baskets_ = {}
    for c, b, p, _ in rows:
        baskets_.setdefault((c, b), []).append(p)
    counts = Counter()
    for items in baskets_.values():
        for a, bb in itertools.combinations(items, 2):
            if a != bb:
                counts[tuple(sorted((a, bb)))] += 1
    total = len(baskets_)
    for min_support in (0.0, 0.02, 0.1, 0.5):
        want = {k: v for k, v in counts.items() if v / total >= min_support}
        got = {(r["product_1"], r["product_2"]): r["pair_count"]
               for r in baskets.basket_pairs(df, min_support, block_items=block_items).collect()}
        assert got == want, (block_items, min_support)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_recency_of_timestamps_in_any_zone(spark, zone):
    from tillroll.operators import customers, rfm
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.sql("""
            SELECT * FROM VALUES ('a', 't1', 'p', 'c', 10.0D, 1.0D, timestamp'2024-05-06 00:30:00', 's', 'l', 'g'),
                                 ('b', 't2', 'p', 'c', 20.0D, 2.0D, timestamp'2024-05-02 23:30:00', 's', 'l', 'g')
            AS t(customer_id, transaction_id, product_id, category, total_amount, profit_amount,
                 transaction_date, customer_segment, country, age_group)""")
        base = {r.customer_id: r.recency for r in rfm.rfm_base(rows).collect()}
        assert base == {"a": 0, "b": 4}
        life = {r.customer_id: r.days_since_last_purchase for r in customers.customer_lifetime(rows).collect()}
        assert life == {"a": 0, "b": 4}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_money_leaves_out_values_that_are_not_finite(spark):
    from tillroll.functions.exprs import money_avg, money_sum
    rows = [(1.25,), (float("nan"),), (float("inf"),), (None,), (2.5,), (-0.75,)]
    got = spark.createDataFrame(rows, "x double").agg(money_sum("x").alias("s"), money_avg("x").alias("a")).first()
    assert (got.s, got.a) == (3.0, 1.0)


def test_partitioned_write_makes_few_files(spark, tmp_path):
    from tillroll.plans.publish import write_table
    rows = spark.range(20_000).repartition(16).selectExpr("id", "id % 12 AS month")
    assert write_table(rows, str(tmp_path / "t"), partition_cols=["month"]) == 20_000
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 24


def test_one_row_per_customer_when_the_dimension_repeats_a_key(spark, transactions, customers, products):
    from tillroll.operators import customers as ops
    twice = customers.unionByName(customers.withColumns({"customer_segment": F.lit("Zeta")}))
    life = ops.customer_lifetime(enrich(transactions, twice, products)).collect()
    once = {r.customer_id: r for r in ops.customer_lifetime(enrich(transactions, customers, products)).collect()}
    assert sorted(r.customer_id for r in life) == sorted(once)
    for r in life:
        assert r.customer_segment == "Zeta"
        assert r.total_spent == 2 * once[r.customer_id].total_spent
