
from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

_ROOT = str(Path(__file__).resolve().parent)
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import spanloom as sl  # noqa: E402
from checks import oracle  # noqa: E402
from spanloom.functions.text import with_bounded_text  # noqa: E402
from spanloom.functions.traceparent import comment_traceparent  # noqa: E402
from spanloom.operators.lineage import cut_lineage, shared_folder  # noqa: E402
from spanloom.operators.spans import operation_label, seconds  # noqa: E402
from spanloom.schemas import SPAN_NODE_FIELDS, SPANS  # noqa: E402
from spanloom.sources.intake import NestedPlans  # noqa: E402
from spanloom.sources.derived import DEFAULT_MIN_DURATION_MS, MARKER, Capture, DeepCapture  # noqa: E402

try:  # the subpackage and the pipeline at the top come and go together
    import corpus_pipeline  # noqa: E402
    from spanloom.llm import queries as corpus  # noqa: E402
except ImportError:
    corpus = corpus_pipeline = None

CONFIG = sl.SpanConfig(default_min_duration_ms=DEFAULT_MIN_DURATION_MS, marker=MARKER)
# Small enough that most trees of the given tables take the joined route.
SPLIT_CONFIG = sl.SpanConfig(
    default_min_duration_ms=DEFAULT_MIN_DURATION_MS, marker=MARKER, max_tree_nodes=3
)
BATCH_CONFIG = sl.SpanConfig(
    default_min_duration_ms=DEFAULT_MIN_DURATION_MS,
    marker=MARKER,
    max_batch_spans=oracle.BATCH_SPANS,
)

Query = Callable[[SparkSession, str], DataFrame]


def _slow(c: Capture) -> DataFrame:
    return sl.slow_executions(c.executions, DEFAULT_MIN_DURATION_MS)


def _in_context(executions: DataFrame) -> DataFrame:
    return sl.attach_trace_context(executions, MARKER)


def _named(c: Capture) -> DataFrame:
    return sl.resolve_relations(c.plan_nodes, c.relations, c.namespaces)


def _named_slow(c: Capture) -> DataFrame:
    """Plan nodes of slow executions only: the filter runs before any tree work."""
    slow_ids = _slow(c).select("query_id")
    nodes = c.plan_nodes.join(slow_ids, "query_id", "left_semi")
    return sl.resolve_relations(nodes, c.relations, c.namespaces)


def _spans(c: Capture, config: sl.SpanConfig = CONFIG) -> DataFrame:
    return sl.build_spans(c.executions, c.plan_nodes, c.relations, c.namespaces, config)


def _nested(c: Capture) -> NestedPlans:
    nodes = _named(c).select("query_id", *SPAN_NODE_FIELDS)
    return sl.nest_plans(c.executions, nodes)


def _with_rest(c: Capture, spans: DataFrame, rest: DataFrame | None) -> DataFrame:
    """``spans`` of nested rows and those of plans that stayed flat."""
    if rest is None:
        return spans
    return spans.unionByName(sl.spans_from_nodes(c.executions, rest, CONFIG))


def _joined(name: str) -> Column:
    return F.array_join(name, ", ").alias(name)


def _plain(spans: DataFrame) -> DataFrame:
    """Lists and timestamps as text, so that every engine compares them alike."""
    shown = {
        "plan_tables": _joined("plan_tables"),
        "start_ts": F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start_ts"),
    }
    return spans.select(*(shown.get(c, F.col(c)) for c in SPANS.fieldNames()))


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def slow_executions(c: Capture) -> DataFrame:
    return _slow(c).select("query_id", "total_ns", "min_duration_ms")


def slow_query_times(c: Capture) -> DataFrame:
    wall_start = F.col("finished_unix_nano") - F.col("total_ns")
    start = wall_start + F.col("start_offset_ns")
    return _slow(c).select(
        "query_id",
        operation_label(F.col("operation")).alias("label"),
        wall_start.alias("wall_start_nano"),
        start.alias("start_unix_nano"),
        (start + F.col("total_ns")).alias("end_unix_nano"),
        seconds(F.col("start_offset_ns")).alias("startup_seconds"),
        seconds(F.col("total_ns")).alias("total_seconds"),
    )


def operation_labels(c: Capture) -> DataFrame:
    return (
        c.executions.groupBy("operation", operation_label(F.col("operation")).alias("label"))
        .agg(F.count(F.lit(1)).alias("executions"))
        .select("operation", "label", "executions")
    )


def comment_traceparents(c: Capture) -> DataFrame:
    found = comment_traceparent(F.col("source_text"), MARKER)
    return c.executions.select("query_id", found.alias("traceparent"))


# Every 97th execution lands as a line that breaks off, every other 89th one without its id.
_LANDED_SQL = """SELECT CASE WHEN query_id % 97 = 0 THEN concat('{{"query_id": ', query_id, ', "total_ns": ')
  WHEN query_id % 89 = 0 THEN concat('{{"total_ns": ', total_ns, '}}')
  ELSE to_json(struct(*)) END AS value FROM {executions}"""


def landed_executions(c: Capture) -> DataFrame:
    """Executions landed as JSON lines and read back, with the lines that are damaged."""
    path = _scratch(c.spark, "landed")
    c.spark.sql(_LANDED_SQL, executions=c.executions).write.text(path)
    rows, damaged = sl.read_landed_executions(c.spark, path)
    return rows.unionByName(damaged.select("line", "reason"), allowMissingColumns=True)


def trace_context(c: Capture) -> DataFrame:
    return _in_context(c.executions).select(
        "query_id", "has_context", "trace_id", "parent_span_id"
    )


def relation_names(c: Capture) -> DataFrame:
    return _named(c).select("query_id", "node_id", "table_name")


def nested_plans(c: Capture) -> DataFrame:
    """One number of each kind over the nodes of every execution, nested or left flat."""
    node_ns = F.aggregate(
        "plan", F.lit(0).cast("bigint"), lambda total, node: total + node["total_ns"]
    )
    nested, rest = sl.nest_plans(c.executions, c.plan_nodes)
    result = nested.select(
        "query_id",
        F.size("plan").cast("bigint").alias("nodes"),
        node_ns.alias("node_ns"),
        F.array_max("plan.node_id").alias("last_node"),
    )
    if rest is None:
        return result
    timed = c.executions.filter(F.col("total_ns").isNotNull()).select("query_id")
    of_rest = rest.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.sum("total_ns").alias("node_ns"),
        F.max("node_id").alias("last_node"),
    )
    return result.unionByName(of_rest.join(timed, "query_id", "left_semi"))


def subtree_tables(c: Capture, config: sl.SpanConfig = CONFIG) -> DataFrame:
    return sl.subtree_tables(_named(c), config, c.plan_nodes).select(
        "query_id", "node_id", "side_path", _joined("tables"), "visible"
    )


def query_tables(c: Capture) -> DataFrame:
    return sl.query_tables(_named(c)).select("query_id", _joined("tables"))


def subtree_table_rows(c: Capture) -> DataFrame:
    return sl.subtree_table_rows(_named(c), counted=c.plan_nodes)


def query_table_rows(c: Capture) -> DataFrame:
    return sl.query_table_rows(_named(c), counted=c.plan_nodes)


def plan_visibility(c: Capture) -> DataFrame:
    return sl.subtree_tables(_named(c)).select("query_id", "node_id", "visible")


def bounded_text(c: Capture) -> DataFrame:
    documents = with_bounded_text(c.table("documents"), "bounded", F.col("text"), 512)
    return documents.select("doc_id", "bounded", F.octet_length("bounded").alias("bytes"))


def query_spans(c: Capture) -> DataFrame:
    tables = sl.query_tables(_named_slow(c), counted=c.plan_nodes)
    return sl.query_spans(_in_context(_slow(c)), tables, CONFIG).select(
        "query_id",
        "trace_id",
        "span_id",
        "parent_span_id",
        "name",
        "start_unix_nano",
        "end_unix_nano",
        "duration_us",
        "db_operation",
        "db_statement",
        "startup_seconds",
        "total_seconds",
        "service_name",
    )


def _plan_spans(c: Capture) -> DataFrame:
    walked = sl.walk_plans(_named_slow(c), counted=c.plan_nodes)
    return sl.plan_spans(walked, _in_context(_slow(c)), CONFIG, counted=c.plan_nodes)


def spans_by_operators(c: Capture) -> DataFrame:
    """Query spans and plan spans of the single operators; together they are the whole job."""
    # Derived and named once: both operators read the nodes and the executions from here.
    nodes, executions = cut_lineage(_named_slow(c)), cut_lineage(_in_context(_slow(c)))
    of_queries = sl.query_spans(executions, sl.query_tables(nodes), CONFIG)
    of_plans = sl.plan_spans(sl.walk_plans(nodes), executions, CONFIG, counted=nodes)
    return _plain(of_queries.unionByName(of_plans))


def plan_span_names(c: Capture) -> DataFrame:
    return _plan_spans(c).select("query_id", "node_id", "name")


def plan_span_times(c: Capture) -> DataFrame:
    return _plan_spans(c).select(
        "query_id",
        "node_id",
        "start_unix_nano",
        "end_unix_nano",
        "startup_seconds",
        "total_seconds",
    )


def plan_tables_capped(c: Capture) -> DataFrame:
    return sl.walk_plans(_named(c)).select("query_id", "node.node_id", _joined("plan_tables"))


def plan_parents(c: Capture) -> DataFrame:
    return _plan_spans(c).select("query_id", "node_id", "span_id", "parent_span_id")


def plan_spans(c: Capture) -> DataFrame:
    return _plain(_plan_spans(c)).drop(
        "level",
        "parent_is_remote",
        "kind",
        "start_ts",
        "flags",
        "status",
        "db_operation",
        "db_statement",
    )


def emit_order(c: Capture) -> DataFrame:
    return _spans(c).select("query_id", "node_id", "level", "emit_order")


def _exploded_attributes(spans: DataFrame) -> DataFrame:
    return (
        sl.with_attributes(spans, CONFIG)
        .select("query_id", "node_id", F.posexplode("attributes").alias("position", "a"))
        .select(
            "query_id",
            "node_id",
            "position",
            "a.key",
            F.col("a.value.s").alias("string_value"),
            F.col("a.value.d").alias("double_value"),
            F.col("a.value.i").alias("int_value"),
            F.col("a.value.b").alias("bool_value"),
            F.array_join("a.value.a", ", ").alias("array_value"),
        )
    )


def query_attributes(c: Capture) -> DataFrame:
    return _exploded_attributes(_spans(c).filter(F.col("level") == "query"))


def plan_attributes(c: Capture) -> DataFrame:
    return _exploded_attributes(_spans(c).filter(F.col("level") == "plan"))


def span_resources(c: Capture) -> DataFrame:
    resource = F.col("resource")
    return (
        sl.with_resource(_spans(c), CONFIG)
        .groupBy(
            resource["service.name"].alias("service_name"),
            resource["service.framework.name"].alias("framework_name"),
            resource["service.framework.version"].alias("framework_version"),
        )
        .agg(F.count(F.lit(1)).alias("spans"))
    )


def otlp_batches(c: Capture) -> DataFrame:
    return sl.otlp_batches(_spans(c), oracle.BATCH_BUCKETS, BATCH_CONFIG).drop("document")


_DOCUMENT_DDL = """resourceSpans ARRAY<STRUCT<
  resource STRUCT<attributes ARRAY<STRUCT<key STRING, value STRUCT<stringValue STRING>>>>,
  scopeSpans ARRAY<STRUCT<spans ARRAY<STRUCT<
    traceId STRING, spanId STRING, parentSpanId STRING, name STRING, kind INT, flags INT,
    startTimeUnixNano STRING, endTimeUnixNano STRING,
    attributes ARRAY<STRUCT<key STRING, value STRUCT<intValue STRING>>>>>>>>>"""


def otlp_documents(c: Capture) -> DataFrame:
    """The spans read back from the export documents."""
    documents = sl.otlp_batches(_spans(c), oracle.BATCH_BUCKETS, BATCH_CONFIG)
    parsed = documents.select(F.from_json("document", _DOCUMENT_DDL).alias("d"))
    of_resource = parsed.select(F.explode("d.resourceSpans").alias("r"))
    spans = of_resource.select(
        F.col("r.resource.attributes")[0]["value"]["stringValue"].alias("service_name"),
        F.explode(F.flatten("r.scopeSpans.spans")).alias("s"),
    )
    return spans.select(
        "service_name",
        F.col("s.traceId").alias("trace_id"),
        F.col("s.spanId").alias("span_id"),
        F.col("s.parentSpanId").alias("parent_span_id"),
        "s.name",
        "s.kind",
        "s.flags",
        F.col("s.startTimeUnixNano").alias("start_unix_nano"),
        F.col("s.endTimeUnixNano").alias("end_unix_nano"),
        F.size("s.attributes").alias("attribute_count"),
        F.try_element_at("s.attributes.value.intValue", F.lit(7)).alias("width_bytes"),
    )


_SENT_DDL = """resourceSpans ARRAY<STRUCT<
  resource STRUCT<attributes ARRAY<STRUCT<key STRING, value STRUCT<stringValue STRING>>>>,
  scopeSpans ARRAY<STRUCT<scope STRUCT<name STRING, version STRING>, spans ARRAY<STRUCT<
    spanId STRING, attributes ARRAY<STRUCT<key STRING, value STRUCT<stringValue STRING,
      doubleValue DOUBLE, intValue STRING, boolValue BOOLEAN,
      arrayValue STRUCT<values ARRAY<STRUCT<stringValue STRING>>>>>>>>>>>>"""


def _sent_attributes(documents: DataFrame) -> DataFrame:
    """Scope and attribute values of all spans in export documents."""
    parsed = documents.select(F.from_json("document", _SENT_DDL).alias("d"))
    of_resource = parsed.select(F.explode("d.resourceSpans").alias("r"))
    of_scope = of_resource.select(
        F.col("r.resource.attributes")[0]["value"]["stringValue"].alias("service_name"),
        F.explode("r.scopeSpans").alias("c"),
    )
    spans = of_scope.select("service_name", "c.scope", F.explode("c.spans").alias("s"))
    attributes = spans.select(
        "service_name", "scope", "s.spanId", F.posexplode("s.attributes").alias("position", "a")
    )
    value = F.col("a.value")
    return attributes.select(
        "service_name",
        F.col("scope.name").alias("scope_name"),
        F.col("scope.version").alias("scope_version"),
        F.col("spanId").alias("span_id"),
        "position",
        "a.key",
        value["stringValue"].alias("string_value"),
        value["doubleValue"].alias("double_value"),
        value["intValue"].cast("bigint").alias("int_value"),
        value["boolValue"].alias("bool_value"),
        F.array_join(value["arrayValue"]["values"]["stringValue"], ", ").alias("array_value"),
    )


def otlp_files(c: Capture) -> DataFrame:
    """Export documents written by one run, which is done a second time, and read back."""
    path = _scratch(c.spark, "documents")
    for _ in range(2):
        documents = sl.otlp_batches(_spans(c), oracle.BATCH_BUCKETS, BATCH_CONFIG)
        sl.write_spans(documents, path, "otlp_json", "replace", run_id="all")
    return _sent_attributes(sl.read_documents(c.spark, path))


# Row groups of a landed file. A micro-batch takes a few files, so files split between all tasks.
LANDED_GROUP_BYTES = 4 * 1024 * 1024


def _land(rows: DataFrame, path: str) -> None:
    writer = rows.write.option("compression", "zstd")
    writer.option("parquet.block.size", LANDED_GROUP_BYTES).parquet(path)


def _streamed(c: Capture, fmt: str) -> tuple[str, str, DataFrame | None]:
    """Nested executions landed as files and streamed; the folders of spans and of the checkpoint,
    and the spans of plans that no landed row holds, or None."""
    spark = c.spark
    landing, sink, offsets = (_scratch(spark, n) for n in ("landing", "streamed", "offsets"))
    nested, rest = _nested(c)
    _land(nested, landing)
    stream = sl.read_executions(spark, landing, streaming=True, maxFilesPerTrigger="4")
    query = sl.stream_spans(
        stream, sink, offsets, config=CONFIG, fmt=fmt, period="year", available_now=True
    )
    query.awaitTermination()
    flat = None if rest is None else sl.spans_from_nodes(c.executions, rest, CONFIG)
    return sink, offsets, flat


def stream_otlp(c: Capture) -> DataFrame:
    """Export documents of a stream, and of plans that stayed flat, read back."""
    spark = c.spark
    sink, _, flat = _streamed(c, "otlp_json")
    documents = spark.read.text(sink).select(F.col("value").alias("document"))
    if flat is not None:
        path = _scratch(spark, "documents")
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        of_flat = sl.otlp_batches(flat, buckets, CONFIG)
        sl.write_spans(of_flat, path, "otlp_json", "replace", run_id="flat")
        documents = documents.unionByName(sl.read_documents(spark, path))
    return _sent_attributes(documents)


def stream_compacted(c: Capture) -> DataFrame:
    """Spans of a stream after its small folders were rewritten by year, twice over.

    Those of plans that stayed flat are a run of their own in the compacted table."""
    sink, offsets, flat = _streamed(c, "parquet")
    table = _scratch(c.spark, "compacted")
    for drop in (False, True):
        sl.compact_spans(c.spark, sink, offsets, table, period="year", drop=drop)
    if flat is not None:
        sl.write_spans(flat, table, mode="replace", period="year", run_id="flat")
    return _plain(sl.read_compacted(c.spark, sink, table))


def span_files(c: Capture) -> DataFrame:
    """The span table written by year as Parquet and read back."""
    spark = c.spark
    path = _scratch(spark, "spans")
    few = sl.few_dates(_slow(c), "year")
    sl.write_spans(_spans(c), path, period="year", rebalance=not few)
    return _plain(spark.read.schema(SPANS).parquet(path))


def stream_spans(c: Capture) -> DataFrame:
    """Nested executions landed as files, streamed to Parquet spans and read back."""
    spark = c.spark
    landing, sink = _scratch(spark, "landing"), _scratch(spark, "streamed")
    nested, rest = _nested(c)
    _land(nested, landing)
    stream = sl.read_executions(spark, landing, streaming=True, maxFilesPerTrigger="4")
    query = sl.stream_spans(
        stream,
        sink,
        _scratch(spark, "offsets"),
        config=CONFIG,
        period="year",
        available_now=True,
    )
    query.awaitTermination()
    return _plain(_with_rest(c, spark.read.schema(SPANS).parquet(sink), rest))


def spans_from_nested(c: Capture) -> DataFrame:
    nested, rest = _nested(c)
    return _plain(_with_rest(c, sl.spans_from_nested(nested, CONFIG), rest))


_QUERIES: dict[str, Callable[[Capture], DataFrame]] = {
    "slow_executions": slow_executions,
    "slow_query_times": slow_query_times,
    "operation_labels": operation_labels,
    "comment_traceparent": comment_traceparents,
    "landed_executions": landed_executions,
    "trace_context": trace_context,
    "relation_names": relation_names,
    "nested_plans": nested_plans,
    "subtree_tables": subtree_tables,
    "subtree_tables_joined": lambda c: subtree_tables(c, SPLIT_CONFIG),
    "subtree_table_rows": subtree_table_rows,
    "query_tables": query_tables,
    "query_table_rows": query_table_rows,
    "plan_visibility": plan_visibility,
    "bounded_text": bounded_text,
    "query_spans": query_spans,
    "plan_span_names": plan_span_names,
    "plan_span_times": plan_span_times,
    "plan_tables_capped": plan_tables_capped,
    "plan_parents": plan_parents,
    "plan_spans": plan_spans,
    "emit_order": emit_order,
    "spans": lambda c: _plain(_spans(c)),
    "spans_by_operators": spans_by_operators,
    "spans_from_nested": spans_from_nested,
    "spans_split_trees": lambda c: _plain(_spans(c, SPLIT_CONFIG)),
    "query_attributes": query_attributes,
    "plan_attributes": plan_attributes,
    "span_resources": span_resources,
    "otlp_batches": otlp_batches,
    "otlp_documents": otlp_documents,
    "otlp_files": otlp_files,
    "span_files": span_files,
    "stream_spans": stream_spans,
    "stream_otlp": stream_otlp,
    "stream_compacted": stream_compacted,
}

# The same operators over trees of which some exceed ``max_tree_nodes`` from sf0.01 on.
_DEEP_QUERIES: dict[str, Callable[[Capture], DataFrame]] = {
    "plan_tables_capped_deep": plan_tables_capped,
    "query_tables_deep": query_tables,
    "query_table_rows_deep": query_table_rows,
    "subtree_table_rows_deep": subtree_table_rows,
    "nested_plans_deep": nested_plans,
    "spans_from_nested_deep": spans_from_nested,
    "spans_deep": lambda c: _plain(_spans(c)),
}


def entry(spark: SparkSession) -> DataFrame:
    """The whole job over the smallest tables."""
    return _plain(_spans(Capture(spark, "/root/testdata/sf0.001")))


def queries() -> dict[str, Query]:
    def bind(build: Callable[[Capture], DataFrame], capture: type[Capture] = Capture) -> Query:
        return lambda spark, sf_dir: build(capture(spark, sf_dir))

    found: dict[str, Query] = {name: bind(build) for name, build in _QUERIES.items()}
    found |= {name: bind(build, DeepCapture) for name, build in _DEEP_QUERIES.items()}
    if corpus is not None:
        found |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    if corpus is not None:
        found |= corpus.SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
