"""Quality checks: a negative amount, a null customer and a zero quantity, and the rows FIXTURES.md adds."""

import pytest
from pyspark.sql import functions as F

from conftest import TXN_SCHEMA, ts
from tillroll.operators import quality


@pytest.fixture(scope="module")
def edge(spark):
    rows = [
        ("E-neg", "k04", "g2", 3, 20.0, 5.0, -17.5, ts("2024-03-02 08:15:00"), "Completed"),
        ("E-null", None, "g4", 2, 45.0, 0.0, 90.0, ts("2023-11-20 19:40:00"), "Completed"),
        ("E-zero", "k03", "g1", 0, 75.0, 0.0, 0.0, ts("2023-02-07 13:05:00"), "Completed"),
    ]
    return spark.createDataFrame(rows, TXN_SCHEMA)


def test_edge_suite_fails_on_null_customer(edge):
    report = quality.quality_report(edge, "transactions")
    verdict = quality.quality_verdict(report).first()
    assert verdict["passed"] is False
    nulls = {r["column_name"]: r for r in quality.null_check(edge, "transactions").collect()}
    assert nulls["customer_id"]["null_count"] == 1
    assert nulls["customer_id"]["null_percentage"] == 33.33
    assert nulls["customer_id"]["passed"] is False
    checks = {r["check_name"] for r in report.collect()}
    assert {"null_values", "duplicates", "data_types", "outliers", "referential_integrity"} <= checks
    ri = quality.integrity_check(edge, "transactions").first()
    assert (ri["null_customer_ids"], ri["passed"]) == (1, False)


def test_duplicates_constant_and_all_null_columns(spark):
    rows = [("a", 1, None, "12", "-3"), ("a", 1, None, "7.5", "x"), ("b", 1, None, "003", None),
            ("a", 1, None, "12", "-3")]
    df = spark.createDataFrame(rows, "k string, c int, n double, digits string, signed string")
    dup = quality.duplicate_check(df, "t").first()
    assert (dup["total_rows"], dup["unique_rows"], dup["duplicate_count"]) == (4, 3, 1)
    assert dup["duplicate_percentage"] == 25.0 and dup["passed"] is False
    nulls = {r["column_name"]: r for r in quality.null_check(df, "t").collect()}
    assert nulls["n"]["null_percentage"] == 100.0 and nulls["n"]["passed"] is False
    types = {r["column_name"]: r for r in quality.numeric_string_check(df, "t").collect()}
    assert types["digits"]["looks_numeric"] is True and types["digits"]["passed"] is False
    assert types["signed"]["looks_numeric"] is False      # a leading minus is not matched
    assert types["k"]["looks_numeric"] is False
    out = {r["column_name"] for r in quality.outlier_check(df, "t").collect()}
    assert "c" not in out and "n" not in out               # stddev 0 / null: skipped


def test_outlier_bounds_and_counts(spark):
    vals = [10.0] * 20 + [1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = quality.outlier_check(df, "t").first()
    mean = sum(vals) / len(vals)
    sd = (sum((v - mean) ** 2 for v in vals) / (len(vals) - 1)) ** 0.5
    assert r["outlier_count"] == 1
    assert r["lower_bound"] == round(mean - 3 * sd, 2)
    assert r["upper_bound"] == round(mean + 3 * sd, 2)
    assert r["outlier_percentage"] == round(100 / 21, 2)


def test_empty_table_passes_with_null_percentages(spark):
    df = spark.createDataFrame([], "a string, b double")
    nulls = quality.null_check(df, "empty").collect()
    assert all(r["null_percentage"] is None and r["passed"] for r in nulls)
    dup = quality.duplicate_check(df, "empty").first()
    assert dup["total_rows"] == 0 and dup["passed"] is True


def test_orphans_and_cleanse(spark, customers):
    tx = spark.createDataFrame([("k01",), ("k99",), (None,), ("k01",)],
                               "customer_id string")
    r = quality.orphan_keys(tx, customers, "customer_id", "t->c").first()
    assert (r["distinct_keys"], r["orphan_keys"], r["passed"]) == (3, 2, False)  # null is an orphan
    dirty = spark.createDataFrame(
        [("c1", None, None), ("c1", None, None), ("c2", "Basic", "UK")],
        "customer_id string, customer_segment string, country string")
    clean = {r["customer_id"]: r for r in quality.cleanse(dirty).collect()}
    assert len(clean) == 2
    assert (clean["c1"]["customer_segment"], clean["c1"]["country"]) == ("Unknown", "Not Specified")


def test_freshness(spark):
    df = spark.createDataFrame([(ts("2024-01-30 00:00:00"),), (ts("2024-01-31 00:00:00"),)], "d timestamp")
    r = quality.freshness(df, "t", "d", "2024-02-01 12:00:00", 48).first()
    assert r["hours_old"] == pytest.approx(36.0) and r["is_fresh"] is True
    r = quality.freshness(df, "t", "d", "2024-02-01 12:00:00", 24).first()
    assert r["is_fresh"] is False
    empty = spark.createDataFrame([], "d timestamp")
    assert quality.freshness(empty, "t", "d", "2024-02-01 00:00:00").first()["is_fresh"] is False


def test_one_scan_for_column_stats(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    plan = quality.column_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_duplicates_exact_with_negative_zero_and_nulls(spark):
    rows = [(0.0, None, "a"), (-0.0, None, "a"), (1.5, "x", None), (1.5, "x", None), (2.0, "y", "b")]
    df = spark.createDataFrame(rows, "v double, s string, t string")
    want_unique = df.distinct().count()
    dup = quality.duplicate_check(df, "t").first()
    assert dup["total_rows"] == 5 and dup["unique_rows"] == want_unique == 3
