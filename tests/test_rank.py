"""Rank by range partitions: key types, nulls, heavy values, one write, plan."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import products


@pytest.fixture()
def many_partitions(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


TIES = {
    "long": lambda: F.col("id"),
    "string": lambda: F.concat(F.lit("P"), F.col("id") % 1000, F.lit("-"), F.col("id")),
    "decimal": lambda: F.col("id").cast("decimal(20,3)") / 7,
    "date": lambda: F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")),
    "binary": lambda: F.unhex(F.lpad(F.hex("id"), 16, "0")),
    "struct": lambda: F.struct((F.col("id") % 7).alias("a"), F.col("id").alias("b")),
}


@pytest.mark.parametrize("tie", TIES)
def test_equals_window_rank(spark, many_partitions, tie):
    # one category holds most rows, one value a third of them, and some are null
    df = spark.range(6000).select(
        F.when(F.col("id") % 5 > 0, F.lit("hot")).when(F.col("id") % 3 > 0, F.lit("c")).alias("g"),
        F.when(F.col("id") % 3 == 0, 5.0).when(F.col("id") % 11 > 0, F.abs(F.hash("id")) % 400 / 8.0).alias("v"),
        TIES[tie]().alias("t"), F.col("id").alias("_at"), "id")
    got = products.rank_desc_within(df, "g", "v", "t", "r")
    assert got.columns == df.columns + ["r"]
    order = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), F.col("t").asc_nulls_last())
    want = df.withColumn("r", F.row_number().over(order))
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())


def test_null_ties_and_equal_rows(spark, many_partitions):
    df = spark.range(900).select((F.col("id") % 2).alias("g"), F.lit(None).cast("double").alias("v"),
                                 F.when(F.col("id") % 3 > 0, F.col("id")).alias("t"))
    ranks = products.rank_desc_within(df, "g", "v", "t", "r").collect()
    for g in (0, 1):
        own = sorted((r.r, r.t) for r in ranks if r.g == g)
        assert [r for r, _ in own] == list(range(1, 451))
        assert [t for _, t in own if t is not None] == sorted(t for _, t in own if t is not None)
        assert all(t is None for _, t in own[300:])


def test_one_write_and_no_window_over_rows(spark, enriched, monkeypatch):
    from tillroll.operators import products as module
    written = []
    real = module.durable
    monkeypatch.setattr(module, "durable", lambda df, name: written.append(name) or real(df, name))
    out = module.product_performance(enriched)
    assert written == ["rank_order"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the only window sums the counts of the partitions
    assert plan.count("Window [") == 1 and "sum(_n" in plan and "percentile" not in plan
