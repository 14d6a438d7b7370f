"""The whole job: executions and plan trees to the span table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.config import SpanConfig
from spanloom.operators import largetrees, plantree
from spanloom.operators.catalog import resolve_relations
from spanloom.operators.context import attach_trace_context
from spanloom.operators.joins import checked_join, measured_bytes
from spanloom.operators.lineage import cut_lineage
from spanloom.operators.slow import slow_executions
from spanloom.operators.spans import (
    EXECUTION_COLUMNS,
    NAME_MAX_BYTES,
    NODE_EXECUTION_COLUMNS,
    as_plan_rows,
    as_query_rows,
    prepare_executions,
    project_spans,
    query_node,
    with_query_name,
)
from spanloom.schemas import SPAN_NODE_FIELDS


def select_executions(executions: DataFrame, config: SpanConfig) -> DataFrame:
    """Slow executions with their trace context."""
    slow = slow_executions(executions, config.default_min_duration_ms)
    return attach_trace_context(slow, config.marker, config.orphan_trace)


def _spans_of_trees(trees: DataFrame, config: SpanConfig) -> DataFrame:
    """Spans of rows that hold the prepared execution and its ``plan``.

    The query span rides along as the last of the exploded nodes, so that both kinds of
    span come from one walk and one pass.
    """
    walked = plantree.walked_trees(trees).withColumn(
        "tables", plantree.sorted_tables(F.col("names"))
    )
    per_query = [*EXECUTION_COLUMNS, "query_name"]
    query_item = F.struct(
        query_node().alias("node"), F.lit(None).cast("array<string>").alias("plan_tables")
    )
    shown = plantree.visible_nodes(F.col("walk"), F.col("names"))
    listed = with_query_name(walked, F.col("tables")).select(
        *per_query, F.concat(shown, F.array(query_item)).alias("items")
    )
    rows = listed.select(*per_query, F.posexplode_outer("items").alias("order", "item")).select(
        *per_query,
        "item.node",
        "item.plan_tables",
        (F.col("order") + 1).cast("bigint").alias("emit_order"),
    )
    return project_spans(rows, config)


def spans_from_nested(executions: DataFrame, config: SpanConfig = SpanConfig()) -> DataFrame:
    """Spans of executions that carry their ``plan`` with table names: no shuffle for usual plans.

    Executions without timings or without a plan root give no span. Plans above
    ``config.max_tree_nodes`` are taken apart and walked by joins; a streaming input is not looked at
    beforehand and walks every plan in its row, see :func:`spanloom.stream_spans`.
    """
    # The threshold comes first: plans of fast executions are not looked at.
    chosen = select_executions(executions, config).filter(
        F.exists("plan", lambda node: node["parent_node_id"].isNull())
    )
    prepared = prepare_executions(chosen, config, keep=["plan"])
    if executions.isStreaming:
        return _spans_of_trees(prepared, config)
    oversized = F.size("plan") > config.max_tree_nodes
    large = cut_lineage(prepared.filter(oversized))
    if large.isEmpty():
        return _spans_of_trees(prepared, config)
    nodes = cut_lineage(large.select("query_id", F.inline("plan")))
    small = _spans_of_trees(prepared.filter(~oversized), config)
    return small.unionByName(_spans_of_large_trees(large.drop("plan"), nodes, config))


def spans_from_nodes(
    executions: DataFrame, named_nodes: DataFrame, config: SpanConfig = SpanConfig()
) -> DataFrame:
    """Spans of flat plan nodes with table names, by joins whatever the size of a tree.

    Meant for the few plans that :func:`spanloom.nest_plans` leaves flat.
    """
    prepared = prepare_executions(select_executions(executions, config), config)
    ids = named_nodes.select("query_id").distinct()
    own = cut_lineage(prepared.join(ids, "query_id", "left_semi"))
    slow = largetrees.nodes_of(named_nodes, own.select("query_id"), config)
    return _spans_of_large_trees(own, cut_lineage(slow), config)


def build_spans(
    executions: DataFrame,
    plan_nodes: DataFrame,
    relations: DataFrame,
    namespaces: DataFrame,
    config: SpanConfig = SpanConfig(),
) -> DataFrame:
    """Spans of flat inputs.

    Only nodes of slow executions are shuffled, once, by query. Where the ids of these fit a broadcast,
    other nodes are left out where they are read, before trees are counted or shuffled. Trees above
    ``config.max_tree_nodes`` take the joined route and are added to the result. Where ids are many,
    nodes of both kinds are found by one join and written once.
    """
    prepared = prepare_executions(select_executions(executions, config), config)
    slow_ids = slow_executions(executions, config.default_min_duration_ms).select("query_id")
    few = measured_bytes(slow_ids) <= config.max_broadcast_bytes
    of_slow = plan_nodes.join(F.broadcast(slow_ids) if few else slow_ids, "query_id", "left_semi")

    large_ids = largetrees.oversized(of_slow if few else plan_nodes, config)
    if large_ids is None or few:
        wanted = of_slow
        if large_ids is not None:
            wanted = largetrees.nodes_of(of_slow, large_ids, config, others=True)
        small = resolve_relations(wanted, relations, namespaces, config)
    else:
        nodes = _marked_nodes(plan_nodes, slow_ids, large_ids, config)
        nodes = cut_lineage(resolve_relations(nodes, relations, namespaces, config))
        small = nodes.filter(~F.col("_large")).drop("_large")
    trees = plantree.gather_trees(small, SPAN_NODE_FIELDS)
    result = _spans_of_trees(prepared.join(trees, "query_id"), config)
    if large_ids is None:
        return result

    slow_large = cut_lineage(large_ids.join(slow_ids, "query_id", "left_semi"))
    if few:
        large = largetrees.nodes_of(plan_nodes, slow_large, config)
        named = cut_lineage(resolve_relations(large, relations, namespaces, config))
    else:
        named = nodes.filter("_large").drop("_large")
    own = cut_lineage(prepared.join(slow_large, "query_id", "left_semi"))
    return result.unionByName(_spans_of_large_trees(own, named, config))


def _marked_nodes(
    plan_nodes: DataFrame, slow_ids: DataFrame, large_ids: DataFrame, config: SpanConfig
) -> DataFrame:
    """The nodes of slow executions, those of ``large_ids`` with ``_large``."""
    marked = large_ids.withColumn("_large", F.lit(True))
    marks = slow_ids.distinct().join(marked, "query_id", "left")
    return checked_join(
        plan_nodes,
        cut_lineage(marks.select("query_id", F.coalesce("_large", F.lit(False)).alias("_large"))),
        on=["query_id"],
        spread=["node_id"],
        how="inner",
        max_broadcast_bytes=config.max_broadcast_bytes,
        salts=config.join_salts,
    )


def _spans_of_large_trees(
    prepared: DataFrame, nodes: DataFrame, config: SpanConfig
) -> DataFrame:
    """Spans of oversized trees; their few executions are joined to the single nodes."""
    placed = largetrees.place(nodes)
    walked = plantree.walk_large(nodes, placed)
    plan_rows = checked_join(
        walked,
        prepared.select(NODE_EXECUTION_COLUMNS),
        on=["query_id"],
        spread=["node.node_id"],
        how="inner",
        max_broadcast_bytes=config.max_broadcast_bytes,
        salts=config.join_salts,
    )
    # Every name takes two bytes at least with its comma, so a bounded name holds none beyond these.
    tables = plantree.large_query_tables(placed.nodes, first=NAME_MAX_BYTES)
    query_rows = prepared.join(tables, "query_id").join(
        plantree.large_shown(placed.nodes), "query_id"
    )
    return project_spans(
        as_plan_rows(plan_rows).unionByName(as_query_rows(query_rows)), config
    )
