"""Plan checks: built-in expressions only, pushdown reaches the scan."""

import pytest

import __spark_entry__ as entry
from conftest import SMOKE

NON_ML = [k for k in sorted(entry.oracle_sql())]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NON_ML)
def test_no_python_udf(spark, name):
    plan = _plan(entry.queries()[name](spark, SMOKE))
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan
    if not name.startswith("op") or name.startswith("op4_"):  # the other corpus operators may run Arrow code in tasks
        assert "MapInArrow" not in plan and "MapInPandas" not in plan and "FlatMapGroups" not in plan


def test_scan_parquet_pushes_filters_and_prunes(spark):
    plan = _plan(entry.queries()["scan_parquet"](spark, SMOKE))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_returnflag), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan


def test_shared_tables_hold_the_columns_that_a_query_reads(spark):
    for name, columns in {"clean_victim_age": {"dr_no", "victim_age"}, "derive_is_arrest": {"dr_no", "status_code"}, "report_lag_days": {"dr_no", "date_reported", "date_occurred"},
                          "exact_sample": {"dr_no", "area_id", "is_violent"}}.items():
        stored = entry.queries()[name](spark, SMOKE).inputFiles()
        assert stored and set(spark.read.parquet(*stored).columns) == columns, name
