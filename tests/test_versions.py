"""Staged publish: atomic switch, partition reruns, digests, aborted runs."""

import glob
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillroll.plans import versions


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="tillroll-versions-")


def sales(spark, factor=1):
    return spark.range(600).select(
        F.when(F.col("id") % 50 > 0, F.concat(F.lit("a/b="), F.col("id") % 3)).alias("shop"),
        (F.col("id") % 4).cast("int").alias("month"), "id", (F.col("id") * factor / 7).alias("amount"),
        F.timestamp_seconds(F.col("id")).alias("at"), F.when(F.col("id") % 9 > 0, F.array("id")).alias("tags"))


def publish(spark, root, df, replace="tables", parts=("shop", "month"), table="sales"):
    v = versions.new_version(spark, root)
    staged = versions.stage(df, root, "curated", table, v, parts)
    versions.switch(spark, root, v, [staged], replace)
    return v


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_round_trip_with_nulls_and_odd_partition_values(spark, root):
    publish(spark, root, sales(spark))
    back = versions.read_current(spark, root, "sales")
    assert same(back, sales(spark)) and back.dtypes == sales(spark).dtypes
    assert versions.verify_current(spark, root).filter("not passed").count() == 0
    listed = versions.manifest(spark, root)
    assert listed.count() == sales(spark).select("shop", "month").distinct().count()
    with pytest.raises(KeyError):
        versions.read_current(spark, root, "other")


def test_a_run_that_dies_leaves_the_old_tables(spark, root):
    publish(spark, root, sales(spark))
    v = versions.new_version(spark, root)
    staged = [versions.stage(sales(spark, 5), root, "curated", t, v, ["month"]) for t in ("sales", "more")]
    # data of two tables is written, then the run dies before, or during, the manifest
    assert same(versions.read_current(spark, root, "sales"), sales(spark))
    staged[0].entries.write.parquet(f"{root}/_manifests/{v}")
    assert versions.current_version(spark, root) != v
    assert same(versions.read_current(spark, root, "sales"), sales(spark))
    # the next run takes a new name and switches both tables at once
    w = versions.new_version(spark, root)
    assert w > v
    staged = [versions.stage(sales(spark, 5), root, "curated", t, w, ["month"]) for t in ("sales", "more")]
    versions.switch(spark, root, w, staged)
    assert same(versions.read_current(spark, root, "sales"), sales(spark, 5))
    assert same(versions.read_current(spark, root, "more"), sales(spark, 5))


def test_a_rerun_replaces_its_partitions_only(spark, root):
    first = publish(spark, root, sales(spark))
    publish(spark, root, sales(spark), table="untouched")
    again = sales(spark, 3).filter("month = 2 or (month = 1 and shop is null)")
    second = publish(spark, root, again, replace="partitions")
    want = sales(spark).filter("not (month = 2 or (month = 1 and shop is null))").unionByName(again)
    back = versions.read_current(spark, root, "sales")
    assert same(back, want)
    by_version = {r[0]: r[1] for r in versions.manifest(spark, root).filter("table = 'sales'")
                  .groupBy("data_version").count().collect()}
    assert by_version[second] == again.select("shop", "month").distinct().count()
    assert versions.verify_current(spark, root).filter("not passed").count() == 0
    # an older version can still be read, and old folders go on request only
    assert same(versions.read_current(spark, root, "sales", first), sales(spark))
    plan = back.filter("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    whole = publish(spark, root, sales(spark, 2))
    gone = versions.drop_old_versions(spark, root)
    assert any(second in g for g in gone) and not any(whole in g for g in gone)
    assert same(versions.read_current(spark, root, "sales"), sales(spark, 2))
    assert same(versions.read_current(spark, root, "untouched"), sales(spark))


def change_one_value(path):
    file = sorted(glob.glob(f"{path}/**/part-*.parquet", recursive=True))[0]
    t = pq.ParquetFile(file).read()
    at = t.column_names.index("amount")
    values = t.column(at).to_pylist()
    values[0] = values[0] + 1e-9
    pq.write_table(t.set_column(at, "amount", pa.array(values, pa.float64())), file,
                   coerce_timestamps="us", allow_truncated_timestamps=True)
    # the local file system's own checksum would notice first
    folder, name = os.path.split(file)
    os.unlink(f"{folder}/.{name}.crc")


def test_one_changed_value_fails_the_write(spark, root):
    with pytest.raises(versions.VerificationError):
        versions.stage(sales(spark), root, "curated", "sales", "00000001-x", ["month"],
                       before_verify=change_one_value)
    assert versions.current_version(spark, root) is None


def test_one_changed_value_fails_the_later_check(spark, root):
    publish(spark, root, sales(spark), parts=("month",))
    v = versions.current_version(spark, root)
    change_one_value(f"{root}/curated/sales/version={v}")
    failed = versions.verify_current(spark, root).filter("not passed").collect()
    assert [(r.table, r.rows) for r in failed] == [("sales", failed[0].rows_found)]


def test_empty_and_unpartitioned_tables(spark, root):
    publish(spark, root, sales(spark).limit(0), parts=())
    back = versions.read_current(spark, root, "sales")
    assert back.count() == 0 and back.dtypes == sales(spark).dtypes
    publish(spark, root, sales(spark), parts=())
    assert same(versions.read_current(spark, root, "sales"), sales(spark))
    foot = versions.footprint(spark, root).first()
    assert (foot["table"], foot.rows, foot.data_versions) == ("sales", 600, 1) and foot.bytes > 0


def test_digest_does_not_depend_on_order_but_on_copies(spark):
    df = sales(spark)
    one = df.agg(versions.digest(df.columns)).first()[0]
    assert df.repartition(7).orderBy("amount").agg(versions.digest(df.columns)).first()[0] == one
    assert df.unionByName(df.limit(1)).agg(versions.digest(df.columns)).first()[0] != one
    swapped = df.withColumn("id", F.when(F.col("id") == 1, 2).when(F.col("id") == 2, 1).otherwise(F.col("id")))
    assert swapped.agg(versions.digest(df.columns)).first()[0] != one
