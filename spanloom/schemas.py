"""Declared schemas of the inputs and of the span table. Nothing is inferred."""

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "STRINGS": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """Build a schema without a running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


EXECUTIONS = _struct(
    "query_id BIGINT, finished_unix_nano BIGINT, total_ns BIGINT, start_offset_ns BIGINT, "
    "operation STRING, source_text STRING, traceparent_setting STRING, min_duration_ms INT, "
    "service_name STRING"
)

# Plan-node fields that end up in a span or steer the walk.
SPAN_NODE = _struct(
    "node_id INT, parent_node_id INT, side STRING, state_type STRING, instrumented BOOLEAN, "
    "startup_cost DOUBLE, total_cost DOUBLE, plan_rows DOUBLE, width_bytes INT, "
    "parallel_aware BOOLEAN, parallel_safe BOOLEAN, async_capable BOOLEAN, "
    "start_offset_ns BIGINT, startup_ns BIGINT, total_ns BIGINT, "
    "rows DOUBLE, secondary_rows DOUBLE, loops DOUBLE, "
    "filtered_scan_join DOUBLE, filtered_other DOUBLE, table_name STRING"
)
SPAN_NODE_FIELDS = SPAN_NODE.fieldNames()

PLAN_NODES = _struct(
    "query_id BIGINT, node_id INT, parent_node_id INT, side STRING, plan_type STRING, "
    "state_type STRING, relation_oid BIGINT, instrumented BOOLEAN, "
    "startup_cost DOUBLE, total_cost DOUBLE, plan_rows DOUBLE, width_bytes INT, "
    "parallel_aware BOOLEAN, parallel_safe BOOLEAN, async_capable BOOLEAN, "
    "start_offset_ns BIGINT, startup_ns BIGINT, total_ns BIGINT, "
    "rows DOUBLE, secondary_rows DOUBLE, loops DOUBLE, "
    "filtered_scan_join DOUBLE, filtered_other DOUBLE"
)

RELATIONS = _struct("relation_oid BIGINT, relation_name STRING, namespace_oid INT")
NAMESPACES = _struct("namespace_oid INT, namespace_name STRING")

# Executions that arrive with their plan and its table names: the streaming input.
NESTED_EXECUTIONS = T.StructType(
    [*EXECUTIONS.fields, T.StructField("plan", T.ArrayType(SPAN_NODE))]
)

SPANS = _struct(
    "query_id BIGINT, node_id INT, level STRING, trace_id STRING, span_id STRING, "
    "parent_span_id STRING, parent_is_remote BOOLEAN, kind STRING, name STRING, "
    "start_unix_nano BIGINT, end_unix_nano BIGINT, start_ts TIMESTAMP, emit_order BIGINT, "
    "flags INT, status STRING, duration_us DOUBLE, "
    "db_operation STRING, db_statement STRING, "
    "node_type STRING, plan_tables STRINGS, startup_cost DOUBLE, total_cost DOUBLE, "
    "plan_rows DOUBLE, width_bytes INT, parallel_aware BOOLEAN, parallel_safe BOOLEAN, "
    "async_capable BOOLEAN, startup_seconds DOUBLE, total_seconds DOUBLE, rows DOUBLE, "
    "secondary_rows DOUBLE, loops DOUBLE, filtered_scan_join DOUBLE, filtered_other DOUBLE, "
    "service_name STRING"
)
