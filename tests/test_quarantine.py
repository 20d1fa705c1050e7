"""Malformed records: kept apart with raw text and file, nulls only in bad fields."""

import os
import tempfile

import pytest
from pyspark.sql import types as T

import __spark_entry__ as entry
from conftest import SF001
from tillroll.sources import quarantine, schemas

CSV = """id,when,amount,note
1,2024-02-03 04:05:06,1.5,fine
2,yesterday,2.5,bad time
3,2024-02-03 04:05:06,lots,bad amount
4,2024-02-03 04:05:06
,2024-02-03 04:05:06,5.5,no key
6,2024-02-03 04:05:06,6.5,"quoted, with a comma"
7,2024-02-03 04:05:06,7.5,one,too many

8,,,
"""
JSON = """{"id":1,"when":"2024-02-03 04:05:06","amount":1.5,"note":"fine"}
{"id":2,"when":"yesterday","amount":2.5,"note":"bad time"}
{"id":3,"amount":"lots","note":"bad amount"}
{"id":4,"amount":
{"amount":5.5,"note":"no key"}
{"id":6,"note":"others are absent","more":[1]}
"""
SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("when", T.TimestampType()),
    T.StructField("amount", T.DoubleType()), T.StructField("note", T.StringType())])


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="tillroll-quarantine-")


def read(spark, folder, text, fmt, **options):
    path = os.path.join(folder, f"in.{fmt}")
    with open(path, "w") as f:
        f.write(text)
    return quarantine.read_with_quarantine(spark, path, SCHEMA, fmt, **options)


def by_id(df):
    return {r["id"]: (r["when"] is not None, r["amount"], r["note"]) for r in df.collect()}


def test_csv(spark, folder):
    p = read(spark, folder, CSV, "csv")
    assert by_id(p.rows) == {1: (True, 1.5, "fine"), 6: (True, 6.5, "quoted, with a comma"), 8: (False, None, None)}
    bad = {r.raw_record.split(",")[0]: r for r in p.quarantine.collect()}
    assert set(bad) == {"2", "3", "4", "", "7"}
    assert bad["2"].raw_record == "2,yesterday,2.5,bad time" and bad["2"].source_file.endswith("in.csv")
    assert {k: r.reason for k, r in bad.items()} == {**dict.fromkeys("2347", "malformed"), "": "missing key"}
    # only the bad field is lost
    assert (bad["2"].fields.amount, bad["2"].fields.note, bad["2"].fields["when"]) == (2.5, "bad time", None)
    assert (bad["3"].fields.amount, bad["3"].fields.note) == (None, "bad amount")


def test_csv_partial_records(spark, folder):
    p = read(spark, folder, CSV, "csv", keep_partial=True)
    rows = by_id(p.rows)
    assert set(rows) == {1, 2, 3, 4, 6, 7, 8}
    assert rows[2] == (False, 2.5, "bad time") and rows[3] == (True, None, "bad amount")
    assert rows[4] == (True, None, None)
    assert p.quarantine.count() == 5


def test_json(spark, folder):
    p = read(spark, folder, JSON, "json", keep_partial=True)
    rows = by_id(p.rows)
    assert rows[1] == (True, 1.5, "fine") and rows[6] == (False, None, "others are absent")
    assert rows[2] == (False, 2.5, "bad time") and rows[3] == (False, None, "bad amount")
    bad = {r.raw_record: r.reason for r in p.quarantine.collect()}
    assert bad['{"id":4,"amount":'] == "malformed" and "missing key" in bad.values() and len(bad) == 4


def test_clashing_names_and_empty_files(spark, folder):
    schema = T.StructType([T.StructField("_raw_record", T.StringType()), T.StructField("_reason", T.LongType()),
                           T.StructField("_source_file", T.StringType())])
    path = os.path.join(folder, "in.csv")
    with open(path, "w") as f:
        f.write("_raw_record,_reason,_source_file\nx,5,y\nx,five,y\n")
    p = quarantine.read_with_quarantine(spark, path, schema)
    assert [tuple(r) for r in p.rows.collect()] == [("x", 5, "y")] and p.quarantine.count() == 1
    p = read(spark, folder, "id,when,amount,note\n", "csv")
    assert p.rows.count() == p.quarantine.count() == 0
    with pytest.raises(ValueError):
        quarantine.read_with_quarantine(spark, path, schema, "orc")


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_whole_table_round_trip_accounts_for_every_record(spark, fmt):
    rows = entry.queries()[f"{fmt}_round_trip"](spark, SF001)
    bad = {(r.reason, r.kind): r.records for r in entry.queries()[f"{fmt}_quarantine"](spark, SF001).collect()}
    total = spark.read.parquet(f"{SF001}/part.parquet").count()
    assert rows.columns == schemas.PRODUCTS.names and sum(bad.values()) > 0
    lost = total - rows.count()
    assert 0 < lost <= sum(bad.values())
