"""Spark jobs that turn captured query executions and plan trees into tracing spans."""

from spanloom.config import SpanConfig
from spanloom.operators.catalog import resolve_relations
from spanloom.operators.context import attach_trace_context
from spanloom.operators.otlp import otlp_batches, with_attributes, with_resource
from spanloom.operators.plantree import (
    query_table_rows,
    query_tables,
    subtree_table_rows,
    subtree_tables,
    walk_plans,
)
from spanloom.operators.slow import slow_executions
from spanloom.operators.spans import plan_spans, query_spans
from spanloom.plans.build import build_spans, spans_from_nested, spans_from_nodes
from spanloom.sinks.files import few_dates, read_documents, read_spans, write_spans
from spanloom.sources.intake import nest_plans, read_executions, read_plan_nodes
from spanloom.sources.landing import read_landed_executions, read_landed_plan_nodes
from spanloom.streaming.compaction import compact_spans, read_compacted
from spanloom.streaming.continuous import stream_spans

__all__ = [
    "SpanConfig",
    "attach_trace_context",
    "build_spans",
    "compact_spans",
    "few_dates",
    "nest_plans",
    "otlp_batches",
    "plan_spans",
    "query_spans",
    "query_table_rows",
    "query_tables",
    "read_compacted",
    "read_documents",
    "read_executions",
    "read_landed_executions",
    "read_landed_plan_nodes",
    "read_plan_nodes",
    "read_spans",
    "resolve_relations",
    "slow_executions",
    "spans_from_nested",
    "spans_from_nodes",
    "stream_spans",
    "subtree_table_rows",
    "subtree_tables",
    "walk_plans",
    "with_attributes",
    "with_resource",
    "write_spans",
]
