"""Readers, writers, profiles and the multi-dataset publish (round trips)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tillroll.plans import publish, versions
from tillroll.sources import model, readers, schemas


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="tillroll-io-")


def test_csv_with_registered_schema(spark, tmp):
    p = os.path.join(tmp, "tx.csv")
    with open(p, "w") as f:
        f.write("transaction_id,customer_id,product_id,quantity,unit_price,discount_amount,"
                "total_amount,transaction_date,payment_method,channel,status\n")
        f.write("T1,C1,P1,2,10.5,1,20,2023-06-15 10:30:00,card,web,Completed\n")
        f.write("T2,C2,P2,notanint,1,0,1,2023-06-16 11:00:00,cash,store,Completed\n")
    df = readers.read_csv_with_schema(spark, p, "transactions")
    rows = {r["transaction_id"]: r for r in df.collect()}
    assert rows["T1"]["quantity"] == 2 and rows["T1"]["total_amount"] == 20.0
    assert rows["T1"]["transaction_date"].hour == 10
    assert rows["T2"]["quantity"] is None                  # malformed field -> null
    assert rows["T1"]["source_file"].endswith("tx.csv")
    assert "ingestion_timestamp" in df.columns
    with pytest.raises(KeyError):
        readers.read_csv_with_schema(spark, p, "nope")
    assert set(schemas.retail_schemas()) == {"customers", "products", "transactions"}


def test_format_dispatch(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    df.write.json(os.path.join(tmp, "j"))
    df.write.option("header", True).csv(os.path.join(tmp, "c"))
    assert readers.read_table(spark, os.path.join(tmp, "j"), "JSON").first()["y"] == "a"
    assert readers.read_table(spark, os.path.join(tmp, "c"), "csv").dtypes == [("x", "string"), ("y", "string")]
    assert readers.read_table(spark, f"{SF001}/region.parquet").count() == 5
    with pytest.raises(ValueError):
        readers.read_table(spark, tmp, "orc")


def test_write_verify_profile(spark, tmp):
    df = model.customers(spark, SF001)
    path = os.path.join(tmp, "customers")
    n = publish.write_table(df, path, "parquet", ["customer_segment"], etl_job_id="job_1")
    assert n == df.count()
    assert publish.verify_write(spark, path, n)
    back = spark.read.parquet(path)
    assert set(back.columns) == set(df.columns) | {"etl_timestamp", "etl_job_id"}
    assert back.select("etl_job_id").distinct().first()[0] == "job_1"
    # partition pruning reaches the scan
    plan = back.filter(F.col("customer_segment") == "BUILDING")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(customer_segment" in plan
    prof = publish.dataset_profile(df, path, "parquet", ["customer_segment"]).first()
    assert prof["record_count"] == n and prof["column_count"] == len(df.columns)
    assert prof["size_estimate_mb"] == round(n * publish.row_bytes(df) / 1048576, 2)
    csv_path = os.path.join(tmp, "csv")
    assert publish.write_table(df, csv_path, "csv") == n
    assert publish.verify_write(spark, csv_path, n, "csv")
    with pytest.raises(ValueError):
        publish.write_table(df, os.path.join(tmp, "x"), "avro2")


def test_publish_all(spark, tmp):
    written = publish.publish_all(spark, model.star(spark, SF001), tmp, etl_job_id="job_7")
    assert set(written) == set(publish.PUBLISH_PLAN)
    enriched = versions.read_current(spark, tmp, "enriched_transactions")
    assert enriched.count() == written["enriched_transactions"] > 0
    assert {"year", "month"} <= set(enriched.columns)
    catalog = spark.read.parquet(os.path.join(tmp, "_catalog"))
    assert catalog.count() == len(publish.PUBLISH_PLAN)
    assert catalog.filter(F.col("record_count") < 0).count() == 0
    rfm = os.path.join(tmp, "curated", "rfm_analysis")
    assert any(p.startswith("rfm_segment=") for v in os.listdir(rfm) for p in os.listdir(os.path.join(rfm, v)))
    listed = {r.dataset: r for r in publish.published_catalog(spark, tmp).collect()}
    assert {n: r.record_count for n, r in listed.items()} == written
    assert all(r.verified and r.footer_rows == r.record_count and (r.bytes > 0) == (r.record_count > 0) for r in listed.values())
    assert all(r.files >= r.partitions and r.data_versions == 1 for r in listed.values())


def test_save_quality_report(spark, tmp):
    from tillroll.operators import quality
    df = model.products(spark, SF001)
    report = quality.quality_report(df, "products")
    quality.save_quality_report(report, os.path.join(tmp, "dq"))
    back = spark.read.json(os.path.join(tmp, "dq"))
    assert back.count() == report.count()
    assert {"dataset", "check_name", "column_name", "metric", "value", "passed"} <= set(back.columns)
