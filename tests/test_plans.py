"""Physical-plan properties: pushdown, pruning, join shapes, no single-partition windows."""

import contextlib
import io
import pathlib

import pytest

from tally.plans import registry, tpch
from tally.sources.fixtures import fixture_frames
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def frames(spark):
    return fixture_frames(spark, SF_SMALL)


def test_date_filters_reach_the_parquet_scan(frames):
    p = plan(tpch.run_query("q4_revenue_forecast", frames, fixture=True))
    pushed = p.split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01" in pushed
    assert "LessThan(l_shipdate,1998-01-01" in pushed


def test_scan_reads_only_needed_columns(frames):
    p = plan(tpch.run_query("q1_pricing_summary", frames))
    schema = p.split("ReadSchema: ")[1].split("\n")[0]
    for col in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"):
        assert col in schema
    for col in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"):
        assert col not in schema


def test_not_in_becomes_anti_join(frames):
    assert "LeftAnti" in optimized(tpch.run_query("q8_supplier_count", frames, fixture=True))


def test_large_orders_aggregates_lineitem_once(frames):
    # The IN-subquery and the outer sum share one aggregate of lineitem.
    text = optimized(tpch.run_query("q9_large_orders", frames))
    assert text.count("l_orderkey#") and sum("Relation" in line and "l_orderkey" in line for line in text.splitlines()) == 1


def test_broadcast_hints_are_fixed_dimensions():
    src = pathlib.Path(tpch.__file__).read_text()
    hinted = [line for line in src.splitlines() if "F.broadcast(" in line]
    fixed = [line for line in hinted if "nation" in line or "regions" in line]
    assert hinted and len(fixed) == len(hinted)


@pytest.mark.parametrize("key", [
    "t1_correlate_event_history", "t2_pivot_task_events", "t4_history_phase_times", "t7_relative_job_times",
    "t9_phase_breakdown_by_duration", "t10_phase_breakdown_by_means", "t11_waiting_times", "t13_timing_table",
    "t14_benchmark_document", "t8_normalize_workers", "a17_worker_activities",
])
def test_per_workflow_operators_never_use_a_single_partition(spark, key):
    p = plan(registry.QUERY_BUILDERS[key](spark, SF_SMALL))
    assert "SinglePartition" not in p


def test_library_never_collects_to_the_driver():
    root = pathlib.Path(tpch.__file__).parents[1]
    own = [f for f in root.rglob("*.py") if f.relative_to(root).parts[0] != "llm"]
    offenders = [str(f) for f in own if ".collect()" in f.read_text() or ".toPandas()" in f.read_text()]
    assert offenders == []


@pytest.mark.parametrize("key", ["q2_shipping_priority", "q3_local_supplier_volume", "q5_returned_items"])
def test_selective_order_side_prunes_lineitem_before_its_shuffle(spark, frames, key):
    # At scale the joins are shuffle joins and lineitem is far larger than the
    # filtered order side. Catalyst then injects a runtime bloom filter into
    # the lineitem scan, below the pre-aggregation, so the rows that cannot
    # join are dropped before they are shuffled. Simulated here by lowering
    # the size thresholds.
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        text = optimized(tpch.run_query(key, frames, fixture=True))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    lineitem_filters = [line for line in text.splitlines() if "might_contain" in line and "l_orderkey" in line]
    assert lineitem_filters, text


@pytest.mark.parametrize("key", sorted(registry.QUERY_BUILDERS))
def test_no_cross_join_nested_loop_or_python_in_any_registered_plan(spark, key):
    p = plan(registry.QUERY_BUILDERS[key](spark, SF_SMALL))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                 "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p, (key, node)


def test_bulk_task_times_reduces_before_grouping(spark):
    """The id list meets the documents below the grouping's exchange."""
    from tally.operators import timing
    from tally.sources import runlogs

    docs = spark.createDataFrame([("w", 0, ("2024-01-01T00:00:00Z",), [], [], [])], runlogs.RUN_DOCUMENT)
    ids = spark.createDataFrame([(0, "w")], "pos long, workflow_id string")
    plan = timing.bulk_task_times(docs, ids)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate [workflow_id"):]
    assert "Join LeftSemi" in below
