"""Plan shape: no Python in any registered query, filters reach the scan."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF001
from tillroll import queries
from tillroll.sources import model


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonMapInArrow",
                "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroupsInPandas",
                "FlatMapCoGroupsInArrow", "AggregateInPandas", "ArrowAggregatePython", "WindowInPandas",
                "ArrowWindowPython", "BatchEvalPythonUDTF", "ArrowEvalPythonUDTF", "FlatMapGroupsInPandasWithState",
                "TransformWithStateInPandas", "TransformWithStateInPySpark", "ExternalRDD", "CartesianProduct")


@pytest.mark.parametrize("name", sorted(queries.registry()))
def test_no_python_in_the_plan_and_runs(spark, name):
    df = queries.registry()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in PYTHON_NODES:
        assert node not in plan, f"{name} uses {node}"
    df.write.format("noop").mode("overwrite").save()


def test_no_python_functions_in_the_library():
    """Intermediate tables are written by plans of their own, so the sources are
    searched too: nothing that would start a Python worker, and no RDD."""
    calls = re.compile(r"\budf\(|pandas_udf|mapIn(Arrow|Pandas)|applyIn(Arrow|Pandas)|\.rdd\b|mapPartitions|"
                       r"\.toPandas\(|foreachPartition")
    for folder in ("functions", "operators", "plans", "sources"):
        for file in pathlib.Path(ROOT, "tillroll", folder).glob("*.py"):
            assert not calls.search(file.read_text()), file


def test_pushdown_and_pruning(spark):
    li = model.load(spark, SF001, "lineitem").filter(F.col("l_quantity") > 40).select("l_orderkey")
    plan = li._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_dimension_join_not_hinted(spark):
    # Broadcast is left to AQE's runtime size check, except for the 25-row nation table.
    plan = model.customers(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and plan.count("strategy=broadcast") == 1


def test_model_enriched_equals_generic_enrich(spark):
    from tillroll.operators.enrich import enrich
    s = model.star(spark, SF001)
    generic = enrich(s["transactions"], s["customers"], s["products"])
    planned = model.enriched(spark, SF001)
    assert planned.columns == generic.columns
    assert planned.dtypes == generic.dtypes
    assert planned.exceptAll(generic).count() == 0 and generic.exceptAll(planned).count() == 0


def test_customer_join_at_order_grain(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = model.enriched(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the customer join's fact side is the orders scan, not line items
    cust_join = plan[plan.index("SortMergeJoin [o_custkey"):]
    assert "FileScan parquet [o_orderkey" in cust_join.split("SortMergeJoin")[1]


def test_completed_filter_pushed_to_orders_scan(spark):
    plan = model.enriched(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan or "In(o_orderstatus, [F])" in plan
