"""What the physical plan of the whole job must look like."""

import re

import pytest

from spanloom import (
    SpanConfig,
    build_spans,
    otlp_batches,
    query_tables,
    spans_from_nested,
    subtree_tables,
    walk_plans,
)
from spanloom.operators import largetrees
from spanloom.schemas import NESTED_EXECUTIONS
from tests.data import catalog, executions, plan_nodes
from tests.test_spans import tree

CONFIG = SpanConfig(default_min_duration_ms=100)
JIT_LIMIT = 8000
TOUR = r"aggregate\(sequence\(1, length\(bin\(cast\(\(\(size\(plan"


@pytest.fixture(scope="module")
def spans(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("capture")
    executions(spark, {}).write.parquet(f"{folder}/runs")
    plan_nodes(spark, *tree(1, 3)).write.parquet(f"{folder}/nodes")
    runs, nodes = spark.read.parquet(f"{folder}/runs"), spark.read.parquet(f"{folder}/nodes")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    # As on a cluster, where neither side of the join by query is small.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield build_spans(runs, nodes, *catalog(spark), CONFIG)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_walk_and_one_shuffle_of_the_nodes(spans):
    plan = plan_of(spans)
    assert plan.count("Generate ") == 1
    # The tour is the only aggregate() over so many rounds; it must not be repeated.
    assert len(re.findall(TOUR, plan)) == 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Nodes and prepared executions by query; the rest is the small catalog. Nodes of fast executions
    # are left out where they are read.
    assert len(re.findall(r"Exchange hashpartitioning\(query_id", plan)) == 2
    assert "BroadcastHashJoin [query_id" in plan
    assert "BroadcastHashJoin [_scanned_oid" in plan


@pytest.mark.parametrize("job", [walk_plans, subtree_tables, query_tables])
def test_each_job_walks_once(spark, job):
    nodes = plan_nodes(spark, *tree(1, 3), table_name=True)
    plan = plan_of(job(nodes))
    assert len(re.findall(TOUR, plan)) == 1
    assert "Python" not in plan


def test_nested_input_needs_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.createDataFrame([], NESTED_EXECUTIONS).write.parquet(path)
    nested = spark.read.schema(NESTED_EXECUTIONS).parquet(path)
    plan = plan_of(spans_from_nested(nested, CONFIG))
    assert len(re.findall(TOUR, plan)) == 1
    assert "Exchange" not in plan


def test_trees_are_counted_without_nodes_of_fast_executions(spark, monkeypatch):
    counted = []
    real = largetrees.oversized
    monkeypatch.setattr(largetrees, "oversized", lambda nodes, c: counted.append(nodes) or real(nodes, c))
    runs = executions(spark, {}, {"query_id": 2, "min_duration_ms": -1})
    nodes = plan_nodes(spark, *tree(1, 3), *tree(2, 5))
    build_spans(runs, nodes, *catalog(spark), CONFIG)
    assert counted[0].count() == 3
    # Without room for a broadcast of the ids, counts are combined before they are filtered.
    build_spans(runs, nodes, *catalog(spark), SpanConfig(max_broadcast_bytes=0))
    assert counted[1].count() == 8


def test_full_texts_are_not_shuffled(spans, capsys):
    spans.explain("formatted")
    shuffled = re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert any("db_statement" in columns for columns in shuffled)
    assert not any("source_text" in columns for columns in shuffled)


def test_filters_and_columns_reach_the_scans(spans):
    plan = plan_of(spans)
    assert "GreaterThanOrEqual(min_duration_ms,0)" in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "query_id:bigint,total_ns:bigint,min_duration_ms:int" in schemas


@pytest.mark.parametrize("batched", [False, True])
def test_generated_methods_can_be_compiled(spans, batched, capsys):
    df = otlp_batches(spans, 4, CONFIG) if batched else spans
    df.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < JIT_LIMIT
