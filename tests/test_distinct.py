"""Mergeable distinct counts: against count_distinct, merging, odd ids, plan."""

from pyspark.sql import functions as F

from tillroll.operators import distinct


def counts(df, by, column):
    return sorted(map(tuple, distinct.count_bitmaps(distinct.distinct_bitmaps(df, by, column), by, "n").collect()),
                  key=str)


def test_equals_count_distinct(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 9 > 0, F.col("id") % 4).alias("g"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 > 0, F.hash("id").cast("long") * 100_003).alias("x"))
    want = sorted(map(tuple, df.groupBy("g").agg(F.count_distinct("x").alias("n")).collect()), key=str)
    assert counts(df, ["g"], "x") == want
    assert counts(df, [], "x") == [(df.select("x").distinct().count() - 1,)]


def test_edges_of_buckets_and_empty(spark):
    ids = [-(2 ** 40), -32768, -1, 0, 1, 32767, 32768, 2 ** 40, 2 ** 40, None]
    df = spark.createDataFrame([(i,) for i in ids], "x long")
    assert counts(df, [], "x") == [(8,)]
    assert counts(df.limit(0), [], "x") == [(0,)]


def test_merged_levels_equal_recounted_ones(spark):
    df = spark.range(5000).select(
        (F.timestamp_seconds(F.col("id") * 40_000)).alias("transaction_date"),
        (F.hash("id") % 300 + 40_000).cast("long").alias("customer_id"))
    got = {(r.period_level, r.period_start): r.active for r in distinct.active_by_period(df).collect()}
    for level in ("day", "month", "quarter", "year"):
        want = {r[0]: r[1] for r in df.groupBy(F.to_date(F.date_trunc(level, "transaction_date"))).agg(
            F.count_distinct("customer_id")).collect()}
        assert {k[1]: v for k, v in got.items() if k[0] == level} == want
    assert got["all", None] == df.select("customer_id").distinct().count()


def test_no_expand_and_one_pass_over_the_rows(spark):
    df = spark.range(10).select(F.lit(1).alias("g"), "id")
    plan = distinct.distinct_bitmaps(df, ["g"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Range (") == 1
