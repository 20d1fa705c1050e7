"""Faulty inputs: every check has a row that fails and every repair changes a value."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF01
from tillroll.operators import quality
from tillroll.sources import dirty, model


def run(spark, name):
    return entry.queries()[name](spark, SF01)


@pytest.mark.parametrize("name", ["dirty_dq_nulls", "dirty_dq_duplicates", "dirty_dq_numeric_strings",
                                  "dirty_dq_report", "dirty_dq_verdict", "dirty_ri_customers",
                                  "dirty_ri_products"])
def test_something_fails(spark, name):
    assert run(spark, name).filter("not passed").count() > 0


@pytest.mark.parametrize("table,columns", [
    ("transactions", ["customer_id"]), ("customers", ["customer_segment", "country"]), ("products", ["category"])])
def test_nulls_fail_where_they_were_put(spark, table, columns):
    failed = run(spark, "dirty_dq_nulls").filter(f"dataset = '{table}' and not passed").collect()
    assert sorted(r.column_name for r in failed) == sorted(columns)


def test_each_dataset_fails_and_the_clean_ones_pass(spark):
    assert {r.dataset: r.passed for r in run(spark, "dirty_dq_verdict").collect()} == dict.fromkeys(
        ("transactions", "customers", "products"), False)
    assert all(r.passed for r in run(spark, "dq_verdict").collect())


def test_faults_are_found_in_number(spark):
    tx = dirty.transactions(spark, SF01)
    clean = model.transactions(spark, SF01)
    dup = {r.dataset: r for r in run(spark, "dirty_dq_duplicates").collect()}
    assert dup["transactions"].duplicate_count == tx.count() - clean.count() > 0
    assert all(not r.passed for r in dup.values())
    orphans = run(spark, "dirty_ri_customers").first()
    wrong = tx.filter(f"customer_id >= {dirty.ORPHAN_OFFSET}").select("customer_id").distinct().count()
    assert orphans.orphan_keys == wrong + 1          # and the null key
    strings = run(spark, "dirty_dq_numeric_strings").filter("looks_numeric").collect()
    assert [(r.dataset, r.column_name) for r in strings] == [("products", "subcategory")]
    out = {(r.dataset, r.column_name): r for r in run(spark, "dirty_dq_outliers").collect()}
    assert out["transactions", "total_amount"].outlier_count > 0


def test_cleansing_fills_and_drops(spark):
    before, after = dirty.customers(spark, SF01), run(spark, "dirty_cleanse")
    assert after.count() == model.customers(spark, SF01).count() < before.count()
    assert after.filter("customer_segment = 'Unknown'").count() > 0
    assert after.filter("country = 'Not Specified'").count() > 0
    assert after.filter("customer_segment is null or country is null").count() == 0
    for name, table in (("dirty_cleanse_transactions", dirty.transactions), ("dirty_cleanse_products", dirty.products)):
        rows = table(spark, SF01)
        assert run(spark, name).count() == rows.distinct().count() < rows.count()


def test_hours_and_unknown_parents_reach_the_enriched_table(spark):
    e = run(spark, "dirty_enriched")
    assert e.select("hour").distinct().count() == 24
    assert e.filter("customer_segment is null").count() > 0
    assert e.filter("brand is null and profit_amount is null").count() > 0


@pytest.mark.parametrize("check", [quality.duplicate_check, quality.outlier_check, quality.quality_report])
def test_the_table_is_read_once(spark, monkeypatch, check):
    """The star join runs in one plan only: the write of the narrow copy, or, for
    duplicates alone, the one aggregation."""
    plans = []
    real = quality.durable
    monkeypatch.setattr(quality, "durable", lambda df, name: plans.append(df) or real(df, name))
    out = check(model.transactions(spark, SF01), "transactions")
    plans.append(out)
    joins = [p._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") for p in plans]
    assert sum(joins) == 1
    assert all("Expand" not in p._jdf.queryExecution().optimizedPlan().toString() for p in plans)


def test_rows_that_differ_in_the_place_of_a_null_are_different(spark):
    rows = [(None, "a"), ("a", None), (None, None), ("a", "a"), ("a", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    r = quality.duplicate_check(df, "t").first()
    assert (r.total_rows, r.unique_rows) == (5, 4)


def test_a_collision_is_flagged_and_counted(spark):
    rows = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (2, 2, 5), (2, 2, 6)], "_h1 long, _h2 long, _h3 long")
    got = {(r._h1): (r.n, r.collided) for r in quality.fingerprint_groups(rows).collect()}
    assert got == {1: (2, False), 2: (2, True)}
    checked = quality.Checked({}, rows, rows)
    assert quality.duplicate_check(rows, "t", checked=checked).first().unique_rows == 3


def test_faults_do_not_depend_on_partitions(spark):
    a = dirty.transactions(spark, SF01)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        b = dirty.transactions(spark, SF01)
        assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    key = spark.range(-3, 3).select(dirty.mixed(F.col("id"), 5).alias("m")).collect()
    assert all(0 <= r.m < dirty.M for r in key)


def test_money_equals_unrounded_sums(spark):
    """Sums at micro-unit resolution against exact sums of the doubles themselves."""
    import math
    rows = model.enriched(spark, SF01).select("year", "month", "total_amount", "profit_amount").collect()
    got = {(r.year, r.month): r for r in entry.queries()["monthly_series"](spark, SF01).collect()}
    for key in got:
        own = [r for r in rows if (r.year, r.month) == key]
        for column, name in (("total_amount", "monthly_revenue"), ("profit_amount", "monthly_profit")):
            exact = math.fsum(r[column] for r in own if r[column] is not None)
            assert abs(got[key][name] - exact) <= 0.005 + 1e-6 * len(own)
