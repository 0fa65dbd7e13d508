"""Plan properties the scale design relies on (checked on executed plans)."""

import re

import pytest

SF = "/root/testdata/sf0.001"
WRITES = {"flatten_csv", "flatten_parquet", "ndjson_roundtrip", "fetch_urls", "stream_ingest", "eta_stream"}


def plan_of(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan):
    return len(re.findall(r"Exchange (hash|range|Single|round)", plan))


def test_no_cartesian_nested_loop_or_row_python(spark):
    import __spark_entry__ as E
    for name in sorted(set(E.queries()) - WRITES):
        plan = plan_of(spark, name)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["split_bundles", "pack_greedy", "chunk_rows", "chunk_stats", "should_split"])
def test_bundle_family_has_one_shuffle(spark, name):
    assert shuffles(plan_of(spark, name)) == 1


def test_reassembly_reuses_the_bundle_partitioning(spark):
    plan = plan_of(spark, "reassemble")
    assert shuffles(plan) == 1 and "REPARTITION_BY_COL" in plan
