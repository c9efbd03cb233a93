"""Plan checks: no Cartesian products, no nested-loop joins and
no Python in any registered query plan that is not an I/O job."""
import pytest

IO_PREFIXES = ("scan_", "lineage_", "rescue_", "sink_", "streaming_table", "materialized_table", "guarded_write",
               "compact_table", "table_properties", "create_schema", "list_tables", "describe_table", "bronze_",
               "stream_", "gold_incremental_refresh")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def _plan_keys():
    from lakestrata.registry import REGISTRY

    return [k for k in REGISTRY if not k.startswith(IO_PREFIXES)]


@pytest.mark.parametrize("key", _plan_keys())
def test_plan_shape(spark, sf_dir, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad}"
    assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan, key


def test_scans_are_pruned(spark, sf_dir):
    import __spark_entry__ as E

    plan = E.queries()["gold_financial"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    cust = [part for part in plan.split("FileScan") if "customer.parquet" in part][0]
    schema = cust[cust.index("ReadSchema: "):].split("\n")[0]
    assert "c_name" not in schema and "c_custkey" in schema  # G2 never reads the name column
    li = E.queries()["dedup_composite"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in li and "l_orderkey" in li and "l_commitdate" not in li and "l_comment" not in li
