import pytest

from spanloom import (
    SpanConfig,
    attach_trace_context,
    build_spans,
    plan_spans,
    resolve_relations,
    spans_from_nested,
    walk_plans,
)
from spanloom.operators import joins
from spanloom.schemas import SPANS
from tests.data import TRACEPARENT, catalog, executions, plan_nodes

CONFIG = SpanConfig(default_min_duration_ms=0)
WALL_START = 8_000_000_000


def tree(query_id: int, size: int, **fields) -> list[dict]:
    """Node i has the children 2i and 2i + 1; node 3 is hidden."""
    return [
        {
            "query_id": query_id,
            "node_id": i,
            "parent_node_id": i // 2 or None,
            "side": None if i == 1 else "LR"[i % 2],
            "relation_oid": 10 + i % 4,
            "instrumented": i != 3,
            **fields,
        }
        for i in range(1, size + 1)
    ]


def inputs(spark, runs, nodes):
    return executions(spark, *runs), plan_nodes(spark, *nodes), *catalog(spark)


def by_order(df, query_id=1):
    return df.filter(df["query_id"] == query_id).orderBy("emit_order").collect()


def test_one_execution(spark):
    runs = [{"source_text": f"  SELECT 1 /* traceparent={TRACEPARENT} */ "}]
    df = build_spans(*inputs(spark, runs, tree(1, 5)), CONFIG)
    assert df.columns == SPANS.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in SPANS]
    spans = by_order(df)
    assert [s.node_id for s in spans] == [4, 5, 2, 1, None]
    assert [s.emit_order for s in spans] == [1, 2, 3, 4, 5]
    by_node = {s.node_id: s for s in spans}
    query, root, leaf = by_node[None], by_node[1], by_node[5]

    assert (query.level, query.kind, query.parent_is_remote) == ("query", "SERVER", True)
    assert query.trace_id == TRACEPARENT[3:35] and query.parent_span_id == TRACEPARENT[36:52]
    # Relations 13 and 14 are unknown; node 3 is hidden and still counts.
    assert query.name == "SELECT c, public.a, public.b"
    assert query.db_statement == f"SELECT 1 /* traceparent={TRACEPARENT} */"
    assert query.start_unix_nano == WALL_START + 500
    assert query.end_unix_nano == WALL_START + 500 + 2_000_000_000
    assert (query.startup_seconds, query.total_seconds) == (5e-07, 2.0)
    assert query.duration_us == 2_000_000.0
    assert query.node_type is None and query.plan_tables is None

    assert (root.level, root.kind, root.parent_is_remote) == ("plan", "INTERNAL", False)
    assert root.parent_span_id == query.span_id
    assert by_node[2].parent_span_id == root.span_id
    assert leaf.parent_span_id == by_node[2].span_id
    assert root.plan_tables == ["public.a", "public.b", "c"]
    assert leaf.name == "postgresql.operation.T_SeqScanState [public.b]"
    assert root.start_unix_nano == WALL_START + 100
    assert root.end_unix_nano == WALL_START + 300
    assert (root.startup_seconds, root.total_seconds) == (2e-07, 3e-07)
    assert root.db_operation is None
    assert len({s.span_id for s in spans}) == 5 and {s.trace_id for s in spans} == {query.trace_id}


@pytest.mark.parametrize(
    ("run", "nodes", "names"),
    [
        ({}, tree(1, 1, relation_oid=None), ["postgresql.operation.T_SeqScanState", "SELECT"]),
        ({"operation": "CMD_OTHER"}, tree(1, 1, instrumented=False), ["UNKNOWN public.b"]),
        ({"operation": None}, tree(1, 1, plan_type="T_Sort", instrumented=False), ["UNKNOWN"]),
        ({"total_ns": None}, tree(1, 1), []),
        ({"min_duration_ms": -1}, tree(1, 1), []),
        ({}, tree(2, 1), []),
    ],
)
def test_names_and_missing_spans(spark, run, nodes, names):
    spans = by_order(build_spans(*inputs(spark, [run], nodes), CONFIG))
    assert [s.name for s in spans] == names


def test_long_names_are_bounded_in_two_ways(spark):
    nodes = tree(1, 1, state_type="T_" + "é" * 40, relation_oid=10)
    plan, query = by_order(build_spans(*inputs(spark, [{}], nodes), CONFIG))
    assert plan.name == "postgresql.operation.T_" + "é" * 20
    assert len(plan.name.encode()) == 63
    relations = spark.createDataFrame([(10, "r" * 70, 1)], "relation_oid BIGINT, relation_name STRING, namespace_oid INT")
    _, namespaces = catalog(spark)
    args = executions(spark, {}), plan_nodes(spark, *nodes), relations, namespaces, CONFIG
    plan, query = by_order(build_spans(*args))
    assert query.name == "SELECT public." + "r" * 47 + "…"
    assert len(query.name.encode()) == 64
    assert plan.plan_tables == []


def test_modes(spark):
    args = inputs(spark, [{}], tree(1, 1))
    config = SpanConfig(default_min_duration_ms=0, duration_us="reference", orphan_trace="derive")
    plan, query = by_order(build_spans(*args, config))
    assert query.duration_us == 2.0 / 1e6
    assert plan.duration_us == 3e-07 * 1e3
    assert query.trace_id == plan.trace_id == "c4ca4238a0b923820dcc509a6f75849b"
    with pytest.raises(ValueError):
        SpanConfig(duration_us="seconds")


def test_all_routes_agree(spark):
    runs = [{"query_id": q, "min_duration_ms": 0 if q != 4 else -1} for q in range(1, 7)]
    nodes = [n for q in range(1, 6) for n in tree(q, 4 * q)]
    args = inputs(spark, runs, nodes)
    whole = sorted(build_spans(*args, CONFIG).collect(), key=repr)
    config = SpanConfig(
        default_min_duration_ms=0, max_tree_nodes=9, max_broadcast_bytes=0, join_salts=3
    )
    assert sorted(build_spans(*args, config).collect(), key=repr) == whole
    visible = {q: sum(n["query_id"] == q and n["node_id"] not in (3, 6, 7, 12, 13, 14, 15)
                      for n in nodes) for q in (1, 2, 3, 5)}
    assert len(whole) == sum(visible.values()) + len(visible)

    from spanloom import nest_plans, resolve_relations, spans_from_nodes
    from spanloom.schemas import SPAN_NODE_FIELDS

    named = resolve_relations(args[1], *args[2:]).select("query_id", *SPAN_NODE_FIELDS)
    nested = spans_from_nested(nest_plans(args[0], named).rows, CONFIG)
    assert sorted(nested.collect(), key=repr) == whole
    large_rows = spans_from_nested(nest_plans(args[0], named).rows, config)
    assert sorted(large_rows.collect(), key=repr) == whole
    small, rest = nest_plans(args[0], named, config)
    both = spans_from_nested(small, config).unionByName(spans_from_nodes(args[0], rest, config))
    assert sorted(both.collect(), key=repr) == whole

    ids = {(s.query_id, s.span_id): s for s in whole}
    assert len(ids) == len(whole)
    for span in whole:
        assert len(span.name.encode()) <= 64
        if span.level == "plan":
            assert ids[span.query_id, span.parent_span_id].emit_order > span.emit_order


def test_walk_is_not_run_to_look_for_large_queries(spark, monkeypatch):
    runs, nodes, *names = inputs(spark, [{}], tree(1, 5))
    walked = walk_plans(resolve_relations(nodes, *names))
    executed, config = attach_trace_context(runs), SpanConfig(max_broadcast_bytes=0)
    hot_keys, looked = joins.hot_keys, []
    monkeypatch.setattr(
        joins, "hot_keys", lambda large, *a: looked.append(large) or hot_keys(large, *a)
    )
    wanted = plan_spans(walked, executed, config).collect()
    got = plan_spans(walked, executed, config, counted=nodes).collect()
    assert looked == [walked, nodes]
    assert len(got) == 4 and sorted(got, key=repr) == sorted(wanted, key=repr)
