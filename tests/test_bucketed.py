"""Bucketed fact tables: no exchange below the join, equal results, hot keys."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tillroll.plans import bucketed
from tillroll.sources import model


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(old, ("-1", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_below_the_join(spark, no_broadcast):
    stored = model.store_bucketed(spark, SF001, 8)
    tx = model.bucketed_transactions(spark, stored, ["F"])
    plan = plan_of(tx)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count("Bucketed: true") == 2
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
    # the plain join shuffles both sides
    assert plan_of(model.transactions(spark, SF001)).count("Exchange") == 2
    # an aggregation by the order key needs no exchange either
    lines = spark.table(stored.lines)
    assert "Exchange" not in plan_of(lines.groupBy("l_orderkey", bucketed.SALT).count())
    stored.drop(spark)


def test_equal_results(spark):
    stored = model.store_bucketed(spark, SF001, 5)
    a, b = model.bucketed_transactions(spark, stored), model.transactions(spark, SF001)
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert spark.table(stored.orders).filter(F.col(bucketed.SALT) > 0).count() == 0
    stored.drop(spark)


def test_a_hot_key_is_spread(spark):
    lines = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 > 0, F.col("id")).alias("k"), F.col("id").alias("x"))
    orders = spark.range(9000).select(F.col("id").alias("ok"), (F.col("id") * 2).alias("y")).unionByName(
        spark.createDataFrame([(None, 1)], "ok long, y long"))
    stored = bucketed.store_fact(lines, orders, "k", "ok", ["x"], 16, rows_per_copy=200)
    got = stored.joined(spark, ["x"], ["y"])
    want = lines.join(orders, F.col("k") == F.col("ok"))
    assert got.count() == want.count()
    assert got.select("k", "x", "y").exceptAll(want.select("k", "x", "y")).count() == 0
    sizes = [r["count"] for r in spark.table(stored.lines).groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) < 1500                       # 3000 lines have the key
    assert spark.table(stored.orders).filter("ok = 7").count() == 16
    stored.drop(spark)
