"""Build query spans and plan spans.

Both kinds are one projection of rows that carry the prepared columns of an execution, a ``node``
struct, ``plan_tables`` and ``emit_order``. The node of a query span has no id and holds the timings
of the execution. The single-pass job and the separate operators share the projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.config import SpanConfig
from spanloom.functions import ids
from spanloom.functions.text import cut_bytes, with_bounded_text
from spanloom.operators.joins import checked_join
from spanloom.operators.lineage import cut_lineage
from spanloom.schemas import SPAN_NODE, SPANS

# Bounds in bytes and the prefix of plan-span names.
NAME_MAX_BYTES = 64
STATEMENT_MAX_BYTES = 512
PLAN_NAME_PREFIX = "postgresql.operation."

# Labels of the known commands.
OPERATION_LABELS = {
    "CMD_SELECT": "SELECT",
    "CMD_UPDATE": "UPDATE",
    "CMD_INSERT": "INSERT",
    "CMD_DELETE": "DELETE",
    "CMD_MERGE": "MERGE",
    "CMD_UTILITY": "UTILITY",
    "CMD_NOTHING": "NOTHING",
}
UNKNOWN_LABEL = "UNKNOWN"

FLAG_SAMPLED = 1
STATUS_OK = "OK"

# What spans need of their execution; the full text is not among it.
EXECUTION_COLUMNS = [
    "query_id",
    "trace_id",
    "parent_span_id",
    "query_span_id",
    "db_operation",
    "db_statement",
    "wall_start_nano",
    "query_start_offset_ns",
    "query_total_ns",
    "service_name",
]

# The part that plan spans need.
NODE_EXECUTION_COLUMNS = [
    "query_id",
    "trace_id",
    "query_span_id",
    "wall_start_nano",
    "service_name",
]


# What the projection of spans reads.
SPAN_ROW_COLUMNS = [
    "query_id",
    "trace_id",
    "parent_span_id",
    "query_span_id",
    "db_operation",
    "db_statement",
    "wall_start_nano",
    "service_name",
    "query_name",
    "node",
    "plan_tables",
    "emit_order",
]


def operation_label(operation: Column) -> Column:
    cases = [operation == command for command in OPERATION_LABELS]
    labels = [F.lit(label) for label in OPERATION_LABELS.values()]
    first = F.when(cases[0], labels[0])
    known = reduce(lambda acc, case: acc.when(*case), zip(cases[1:], labels[1:]), first)
    return known.otherwise(F.lit(UNKNOWN_LABEL))


def with_query_name(rows: DataFrame, tables: Column) -> DataFrame:
    """Add ``query_name``: label and sorted tables; without tables the bare label."""
    full = F.concat(F.col("db_operation"), F.lit(" "), F.array_join(tables, ", "))
    return with_bounded_text(rows, "query_name", full, NAME_MAX_BYTES)


def prepare_executions(
    executions: DataFrame, config: SpanConfig = SpanConfig(), keep: list[str] | None = None
) -> DataFrame:
    """Reduce executions with trace context to :data:`EXECUTION_COLUMNS` and the columns ``keep``.

    Statements are bounded here, so that full texts never travel through a shuffle.
    """
    statement = F.coalesce("source_text", F.lit(""))
    return with_bounded_text(executions, "db_statement", statement, STATEMENT_MAX_BYTES).select(
        "query_id",
        "trace_id",
        "parent_span_id",
        ids.query_span_id(F.col("query_id")).alias("query_span_id"),
        operation_label(F.col("operation")).alias("db_operation"),
        "db_statement",
        (F.col("finished_unix_nano") - F.col("total_ns")).alias("wall_start_nano"),
        F.col("start_offset_ns").alias("query_start_offset_ns"),
        F.col("total_ns").alias("query_total_ns"),
        F.coalesce("service_name", F.lit(config.service_name)).alias("service_name"),
        *(keep or []),
    )


def query_node() -> Column:
    """The node struct of a query span: no id, no plan facts, the timings of the execution."""
    timings = {
        "start_offset_ns": F.col("query_start_offset_ns"),
        "startup_ns": F.col("query_start_offset_ns"),
        "total_ns": F.col("query_total_ns"),
    }
    return F.struct(
        *(
            timings.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in SPAN_NODE.fields
        )
    )


def seconds(ns: Column) -> Column:
    return ns / F.lit(1e9)


def duration_us(ns: Column, is_query: Column, mode: str) -> Column:
    if mode == "true":
        return ns / F.lit(1000.0)
    return F.when(is_query, seconds(ns) / F.lit(1e6)).otherwise(seconds(ns) * F.lit(1e3))


def project_spans(rows: DataFrame, config: SpanConfig = SpanConfig()) -> DataFrame:
    """The span table, see :data:`spanloom.schemas.SPANS`.

    Names are put together in a step of their own and cut in the next: repeated in every branch of
    the cut, they would make the generated code too long for the JIT compiler.
    """
    node, query_id = F.col("node"), F.col("query_id")
    own_table = F.coalesce(F.concat(F.lit(" ["), node["table_name"], F.lit("]")), F.lit(""))
    rows = rows.withColumns(
        {
            "_plan_name": F.concat(F.lit(PLAN_NAME_PREFIX), node["state_type"], own_table),
            "_start": F.col("wall_start_nano") + node["start_offset_ns"],
        }
    )
    is_query = node["node_id"].isNull()

    def either(query: Column, plan: Column) -> Column:
        return F.when(is_query, query).otherwise(plan)

    # The end of a query counts from its own start, the end of a node from the start of the query.
    end_base = either(F.col("_start"), F.col("wall_start_nano"))
    columns = {
        "query_id": query_id,
        "level": either(F.lit("query"), F.lit("plan")),
        "trace_id": F.col("trace_id"),
        "span_id": either(F.col("query_span_id"), ids.node_span_id(query_id, node["node_id"])),
        "parent_span_id": F.when(is_query, F.col("parent_span_id"))
        .when(node["parent_node_id"].isNull(), F.col("query_span_id"))
        .otherwise(ids.node_span_id(query_id, node["parent_node_id"])),
        "parent_is_remote": is_query,
        "kind": either(F.lit("SERVER"), F.lit("INTERNAL")),
        # Plan names are cut hard, without trimming or ellipsis.
        "name": either(F.col("query_name"), cut_bytes(F.col("_plan_name"), NAME_MAX_BYTES)),
        "start_unix_nano": F.col("_start"),
        "end_unix_nano": end_base + node["total_ns"],
        "start_ts": F.timestamp_micros(F.expr("_start DIV 1000")),
        "emit_order": F.col("emit_order"),
        "flags": F.lit(FLAG_SAMPLED),
        "status": F.lit(STATUS_OK),
        "duration_us": duration_us(node["total_ns"], is_query, config.duration_us),
        "db_operation": F.when(is_query, F.col("db_operation")),
        "db_statement": F.when(is_query, F.col("db_statement")),
        "node_type": node["state_type"],
        "plan_tables": F.when(~is_query, F.col("plan_tables")),
        "startup_seconds": seconds(node["startup_ns"]),
        "total_seconds": seconds(node["total_ns"]),
        "service_name": F.col("service_name"),
    }
    # Columns that are not computed are copied from the node.
    return rows.select(
        *(
            (columns[name] if name in columns else node[name]).alias(name)
            for name in SPANS.fieldNames()
        )
    )


def query_spans(
    executions: DataFrame, query_tables: DataFrame, config: SpanConfig = SpanConfig()
) -> DataFrame:
    """One span per execution with trace context that has a plan.

    ``emit_order`` is the number of visible nodes plus one where ``query_tables`` knows that number
    (``shown``), else null.
    """
    rows = prepare_executions(executions, config).join(query_tables, "query_id")
    return project_spans(as_query_rows(rows), config)


def as_query_rows(rows: DataFrame) -> DataFrame:
    order = F.col("shown") + 1 if "shown" in rows.columns else F.lit(None)
    named = with_query_name(rows, F.col("tables")).withColumns(
        {
            "node": query_node(),
            "plan_tables": F.lit(None).cast("array<string>"),
            "emit_order": order.cast("bigint"),
        }
    )
    return named.select(SPAN_ROW_COLUMNS)


def plan_spans(
    walked_plans: DataFrame,
    executions: DataFrame,
    config: SpanConfig = SpanConfig(),
    counted: DataFrame | None = None,
) -> DataFrame:
    """One span per visible node, from :func:`~spanloom.operators.plantree.walk_plans` and the
    executions with trace context they belong to.

    Queries with many nodes are looked for in ``counted`` where given, such as the nodes that were
    walked: in ``walked_plans`` the walk would run once more for it.
    """
    prepared = prepare_executions(executions, config).select(NODE_EXECUTION_COLUMNS)
    rows = checked_join(
        walked_plans,
        cut_lineage(prepared),
        on=["query_id"],
        spread=["node.node_id"],
        how="inner",
        max_broadcast_bytes=config.max_broadcast_bytes,
        salts=config.join_salts,
        counted=counted,
    )
    return project_spans(as_plan_rows(rows), config)


def as_plan_rows(rows: DataFrame) -> DataFrame:
    """Add the columns that only query spans use."""
    only_query = ["parent_span_id", "db_operation", "db_statement", "query_name"]
    nulls = {name: F.lit(None).cast("string") for name in only_query}
    return rows.withColumns(nulls).select(SPAN_ROW_COLUMNS)
