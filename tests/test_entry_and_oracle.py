"""Driver contract and the DuckDB cross-check of every registered query."""

import os

import pytest

import __spark_entry__ as entry
from tillroll import oracle, queries
from conftest import SF001, SF01
from oracle_compare import compare, duck

ORACLE_SF = os.environ.get("TILLROLL_ORACLE_SF", SF01)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "monthly_revenue" in df.columns


def test_every_query_has_oracle():
    assert set(queries.registry()) == set(oracle.registry())
    assert set(queries.registry()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(ORACLE_SF)


@pytest.mark.parametrize("name", sorted(oracle.registry()))
def test_matches_oracle(spark, con, name):
    problems = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], ORACLE_SF, con)
    assert not problems, problems


def test_many_customers_through_the_lifetime_operator(spark):
    """20,000 purchases of 500 customers, 40 each, ten days apart."""
    from pyspark.sql import functions as F
    from tillroll.operators import customers
    rows = spark.range(20_000).select(
        (F.col("id") % 500).alias("customer_id"), F.col("id").cast("string").alias("transaction_id"),
        (F.col("id") % 7).alias("product_id"), F.lit("c").alias("category"),
        (F.col("id") % 500 + 0.25).alias("total_amount"), F.lit(1.5).alias("profit_amount"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.floor(F.col("id") / 500) * 864_000).alias("transaction_date"),
        *[F.lit("x").alias(c) for c in customers.ATTRIBUTES])
    got = customers.customer_lifetime(rows).collect()
    assert len(got) == 500
    for r in got:
        assert (r.total_orders, r.unique_products_purchased, r.customer_lifespan_days) == (40, 7, 390)
        assert r.total_spent == 40 * (r.customer_id + 0.25) and r.total_profit_generated == 60.0
        assert r.purchase_frequency == pytest.approx(40 / 13)


@pytest.mark.parametrize("name", ["enriched_transactions", "cohort_retention", "freshness",
                                  "log_trend", "customer_lifetime"])
def test_time_zone_independent(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        problems = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name],
                           ORACLE_SF, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert not problems, problems


@pytest.mark.parametrize("name,table", [("cleanse", "customer"), ("cleanse_products", "part"),
                                        ("cleanse_transactions", "lineitem")])
def test_cleanse_removes_repeated_rows(spark, tmp_path, name, table):
    import pyarrow as pa
    import pyarrow.parquet as pq
    for f in os.listdir(SF001):
        os.symlink(f"{SF001}/{f}", tmp_path / f)
    once = pq.read_table(f"{SF001}/{table}.parquet")
    os.unlink(tmp_path / f"{table}.parquet")
    pq.write_table(pa.concat_tables([once, once.slice(0, 50)]), tmp_path / f"{table}.parquet")
    query = entry.queries()[name]
    assert query(spark, str(tmp_path)).count() == query(spark, SF001).count() == once.num_rows
    assert not compare(spark, name, query, entry.oracle_sql()[name], str(tmp_path), duck(str(tmp_path)))
