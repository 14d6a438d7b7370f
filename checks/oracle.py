"""The same results in plain SQL, for the engine that checks this library.

Every statement starts from the given tables. Common table expressions are put together by need.
"""

from __future__ import annotations

from spanloom.sources.derived import (
    CHECK_MICROS,
    DEEP_PLAN_NODES_SQL,
    DEEP_RELATIONS_SQL,
    EXECUTIONS_SQL,
    NAMESPACES_SQL,
    PLAN_NODES_SQL,
    RELATIONS_SQL,
)

MARKER = "mark.traceparent="
THRESHOLD_MS = 100
BATCH_BUCKETS = 16
BATCH_SPANS = 64
ZERO_TRACE = "0" * 32
ZERO_SPAN = "0" * 16

_TRACE_FIELDS = "[0-9a-f]{32}-[0-9a-f]{16}-[0-9a-f]{2}"
_BLANK = "".join(
    chr(c)
    for c in [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)


def _cut(text: str, limit: int) -> str:
    """The longest prefix of whole characters within ``limit`` bytes."""
    return (
        f"left({text}, list_max(list_filter(range(0, {limit + 1}), "
        f"lambda n: strlen(left({text}, n)) <= {limit})))"
    )


def _bounded(text: str, limit: int) -> str:
    return (
        f"CASE WHEN strlen({text}) <= {limit} THEN {text} "
        f"ELSE {_cut(text, limit - 3)} || '…' END"
    )


def _span_id(part: str) -> str:
    return f"substr(md5(CAST(query_id AS VARCHAR) || '|' || {part}), 1, 16)"


# name -> (names it builds on, statement)
_PARTS: dict[str, tuple[list[str], str]] = {
    "executions": (
        [],
        EXECUTIONS_SQL.replace("{micros}", CHECK_MICROS).replace("{orders}", "orders"),
    ),
    "plan_nodes": ([], PLAN_NODES_SQL.replace("{lineitem}", "lineitem")),
    "relations": ([], RELATIONS_SQL.replace("{supplier}", "supplier")),
    "namespaces": ([], NAMESPACES_SQL.replace("{nation}", "nation")),
    "slow": (
        ["executions"],
        f"""SELECT *, coalesce(service_name, 'postgresql') AS service,
          CASE operation WHEN 'CMD_SELECT' THEN 'SELECT' WHEN 'CMD_UPDATE' THEN 'UPDATE'
            WHEN 'CMD_INSERT' THEN 'INSERT' WHEN 'CMD_DELETE' THEN 'DELETE'
            WHEN 'CMD_MERGE' THEN 'MERGE' WHEN 'CMD_UTILITY' THEN 'UTILITY'
            WHEN 'CMD_NOTHING' THEN 'NOTHING' ELSE 'UNKNOWN' END AS label
        FROM executions
        WHERE coalesce(min_duration_ms, {THRESHOLD_MS}) >= 0
          AND total_ns >= CAST(coalesce(min_duration_ms, {THRESHOLD_MS}) AS BIGINT) * 1000000""",
    ),
    "pieces": (
        ["executions"],
        r"""SELECT query_id, generate_subscripts(p, 1) AS i, unnest(p) AS piece
        FROM (SELECT query_id, regexp_extract_all(source_text,
            '/\*|\*/|[ \t\n\f\r]+|[^ \t\n\f\r*/]+|[*/]') AS p FROM executions) t""",
    ),
    "commented": (
        ["pieces"],
        f"""SELECT query_id, substr(arg_min(piece, i), {len(MARKER) + 1}) AS found
        FROM (SELECT *, lag(piece) OVER w AS before,
            sum(CASE piece WHEN '/*' THEN 1 WHEN '*/' THEN -1 ELSE 0 END) OVER w AS depth
          FROM pieces WINDOW w AS (PARTITION BY query_id ORDER BY i)) t
        WHERE depth > 0 AND starts_with(piece, '{MARKER}')
          AND (before = '/*' OR regexp_full_match(before, '[ \\t\\n\\f\\r]+'))
        GROUP BY query_id""",
    ),
    "context": (
        ["executions", "commented"],
        f"""SELECT query_id, valid AS has_context,
          CASE WHEN valid THEN substr(tp, 4, 32) ELSE '{ZERO_TRACE}' END AS trace_id,
          CASE WHEN valid THEN substr(tp, 37, 16) ELSE '{ZERO_SPAN}' END AS parent_span_id
        FROM (SELECT query_id, tp, coalesce(
            (regexp_full_match(tp, '00-{_TRACE_FIELDS}')
              OR (left(tp, 2) NOT IN ('00', 'ff')
                AND regexp_full_match(tp, '[0-9a-f]{{2}}-{_TRACE_FIELDS}(-.*)?')))
            AND substr(tp, 4, 32) <> '{ZERO_TRACE}' AND substr(tp, 37, 16) <> '{ZERO_SPAN}',
            false) AS valid
          FROM (SELECT query_id, coalesce(traceparent_setting, found) AS tp
            FROM executions LEFT JOIN commented USING (query_id)) t) t""",
    ),
    "named": (
        ["plan_nodes", "relations", "namespaces"],
        """SELECT n.*, CASE WHEN s.namespace_name IS NULL THEN r.relation_name
            ELSE s.namespace_name || '.' || r.relation_name END AS table_name
        FROM plan_nodes n
        LEFT JOIN relations r ON r.relation_oid = n.relation_oid AND n.plan_type IN
          ('T_SeqScan', 'T_SampleScan', 'T_IndexScan', 'T_IndexOnlyScan', 'T_BitmapIndexScan',
           'T_BitmapHeapScan', 'T_TidScan', 'T_TidRangeScan', 'T_SubqueryScan', 'T_FunctionScan',
           'T_ValuesScan', 'T_TableFuncScan', 'T_CteScan', 'T_NamedTuplestoreScan',
           'T_WorkTableScan', 'T_ForeignScan', 'T_CustomScan')
        LEFT JOIN namespaces s ON s.namespace_oid = r.namespace_oid""",
    ),
    "walk": (
        ["named"],
        """SELECT query_id, node_id, parent_node_id, '' AS side_path, instrumented AS visible,
          table_name FROM named WHERE parent_node_id IS NULL
        UNION ALL
        SELECT n.query_id, n.node_id, n.parent_node_id,
          w.side_path || CASE n.side WHEN 'L' THEN '0' ELSE '1' END,
          w.visible AND n.instrumented, n.table_name
        FROM walk w JOIN named n ON n.query_id = w.query_id AND n.parent_node_id = w.node_id""",
    ),
    "firsts": (
        ["walk"],
        """SELECT a.query_id, a.node_id, d.table_name, min(d.side_path || '2') AS first_at
        FROM walk a JOIN walk d
          ON d.query_id = a.query_id AND starts_with(d.side_path, a.side_path)
        WHERE d.table_name IS NOT NULL GROUP BY ALL""",
    ),
    "subtrees": (
        ["walk", "firsts"],
        """SELECT w.query_id, w.node_id, w.side_path, w.visible,
          coalesce(string_agg(f.table_name, ', ' ORDER BY f.first_at), '') AS tables
        FROM walk w LEFT JOIN firsts f USING (query_id, node_id) GROUP BY ALL""",
    ),
    "roots": (
        ["walk"],
        """SELECT query_id, coalesce(string_agg(DISTINCT table_name, ', ' ORDER BY table_name), '')
          AS tables FROM walk GROUP BY query_id""",
    ),
    "capped": (
        ["walk", "firsts"],
        """SELECT w.query_id, w.node_id,
          coalesce(string_agg(f.table_name, ', ' ORDER BY f.first_at), '') AS plan_tables
        FROM walk w LEFT JOIN (SELECT *, row_number() OVER
            (PARTITION BY query_id, node_id ORDER BY first_at) AS n
          FROM firsts WHERE strlen(table_name) <= 64) f
          ON f.query_id = w.query_id AND f.node_id = w.node_id AND f.n <= 12
        WHERE w.visible GROUP BY ALL""",
    ),
    "orders_of": (
        ["walk"],
        """SELECT query_id, node_id, CAST(row_number() OVER
          (PARTITION BY query_id ORDER BY side_path || '2') AS BIGINT) AS emit_order
        FROM walk WHERE visible""",
    ),
    "shown": (
        ["walk"],
        """SELECT query_id, CAST(count(*) FILTER (WHERE visible) AS BIGINT) AS n
        FROM walk GROUP BY query_id""",
    ),
    "query_span": (
        ["slow", "context", "roots", "shown"],
        f"""SELECT query_id, CAST(NULL AS INTEGER) AS node_id, 'query' AS level, trace_id,
          {_span_id("'q'")} AS span_id, parent_span_id, true AS parent_is_remote,
          'SERVER' AS kind, {_bounded("full_name", 64)} AS name,
          wall_start + start_offset_ns AS start_unix_nano,
          wall_start + start_offset_ns + total_ns AS end_unix_nano,
          n + 1 AS emit_order, total_ns / 1000.0 AS duration_us,
          label AS db_operation, {_bounded("trimmed", 512)} AS db_statement,
          start_offset_ns / 1e9 AS startup_seconds, total_ns / 1e9 AS total_seconds, service
        FROM (SELECT *, finished_unix_nano - total_ns AS wall_start,
            trim(label || ' ' || tables, '{_BLANK}') AS full_name,
            trim(coalesce(source_text, ''), '{_BLANK}') AS trimmed
          FROM slow JOIN context USING (query_id) JOIN roots USING (query_id)
          JOIN shown USING (query_id)) t""",
    ),
    "plan_span": (
        ["slow", "context", "named", "capped", "orders_of"],
        f"""SELECT query_id, node_id, 'plan' AS level, trace_id,
          {_span_id("CAST(node_id AS VARCHAR)")} AS span_id,
          CASE WHEN parent_node_id IS NULL THEN {_span_id("'q'")}
            ELSE {_span_id("CAST(parent_node_id AS VARCHAR)")} END AS parent_span_id,
          false AS parent_is_remote, 'INTERNAL' AS kind,
          CASE WHEN strlen(full_name) <= 64 THEN full_name ELSE {_cut("full_name", 64)} END AS name,
          wall_start + node_offset AS start_unix_nano, wall_start + node_total AS end_unix_nano,
          emit_order, node_total / 1000.0 AS duration_us, state_type AS node_type, plan_tables,
          startup_cost, total_cost, plan_rows, width_bytes, parallel_aware, parallel_safe,
          async_capable, startup_ns / 1e9 AS startup_seconds, node_total / 1e9 AS total_seconds,
          rows, secondary_rows, loops, filtered_scan_join, filtered_other, service
        FROM (SELECT n.*, n.start_offset_ns AS node_offset, n.total_ns AS node_total,
            c.trace_id, s.service, p.plan_tables, o.emit_order,
            s.finished_unix_nano - s.total_ns AS wall_start,
            'postgresql.operation.' || n.state_type ||
              coalesce(' [' || n.table_name || ']', '') AS full_name
          FROM named n JOIN slow s USING (query_id) JOIN context c USING (query_id)
          JOIN capped p USING (query_id, node_id) JOIN orders_of o USING (query_id, node_id)) t""",
    ),
    "spans": (
        ["query_span", "plan_span"],
        """SELECT query_id, node_id, level, trace_id, span_id, parent_span_id, parent_is_remote,
          kind, name, start_unix_nano, end_unix_nano,
          strftime(make_timestamp(start_unix_nano // 1000), '%Y-%m-%d %H:%M:%S.%f') AS start_ts,
          emit_order, CAST(1 AS INTEGER) AS flags, 'OK' AS status, duration_us, db_operation,
          db_statement, node_type, plan_tables, startup_cost, total_cost, plan_rows, width_bytes,
          parallel_aware, parallel_safe, async_capable, startup_seconds, total_seconds, rows,
          secondary_rows, loops, filtered_scan_join, filtered_other, service AS service_name
        FROM (SELECT * FROM query_span UNION ALL BY NAME SELECT * FROM plan_span) t""",
    ),
}

# Parts of the capture with larger trees.
_DEEP_PARTS: dict[str, tuple[list[str], str]] = {
    "plan_nodes": ([], DEEP_PLAN_NODES_SQL.replace("{lineitem}", "lineitem")),
    "relations": ([], DEEP_RELATIONS_SQL.replace("{supplier}", "supplier")),
}

_QUERY_KEYS = [
    ("db.operation", "s", "db_operation"),
    ("db.statement", "s", "db_statement"),
    ("db.system", "s", "'postgresql'"),
    ("postgresql.execution.startup_time_seconds", "d", "startup_seconds"),
    ("postgresql.execution.total_time_seconds", "d", "total_seconds"),
    ("span.duration.us", "d", "duration_us"),
    ("span.type", "s", "'db'"),
    ("span.subtype", "s", "'postgresql'"),
]
_PLAN_KEYS = [
    ("db.system", "s", "'postgresql'"),
    ("postgresql.plan.node_type", "s", "node_type"),
    ("postgresql.plan.tables", "a", "plan_tables"),
    ("postgresql.plan.startup_cost", "d", "startup_cost"),
    ("postgresql.plan.total_cost", "d", "total_cost"),
    ("postgresql.plan.rows", "d", "plan_rows"),
    ("postgresql.plan.width_bytes", "i", "width_bytes"),
    ("postgresql.plan.parallel_aware", "b", "parallel_aware"),
    ("postgresql.plan.parallel_safe", "b", "parallel_safe"),
    ("postgresql.plan.async_capable", "b", "async_capable"),
    ("postgresql.instrumentation.startup_time_seconds", "d", "startup_seconds"),
    ("postgresql.instrumentation.total_time_seconds", "d", "total_seconds"),
    ("postgresql.instrumentation.rows", "d", "rows"),
    ("postgresql.instrumentation.secondary_rows", "d", "secondary_rows"),
    ("postgresql.instrumentation.loops", "d", "loops"),
    ("postgresql.instrumentation.rows_removed_by_scan_or_join_filter", "d", "filtered_scan_join"),
    ("postgresql.instrumentation.rows_removed_by_other_filter", "d", "filtered_other"),
    ("span.duration.us", "d", "duration_us"),
    ("span.type", "s", "'db'"),
    ("span.subtype", "s", "'internal'"),
]
_VALUE_TYPES = {"s": "VARCHAR", "d": "DOUBLE", "i": "BIGINT", "b": "BOOLEAN", "a": "VARCHAR"}
_VALUE_NAMES = {
    "s": "string_value",
    "d": "double_value",
    "i": "int_value",
    "b": "bool_value",
    "a": "array_value",
}


def _exploded(source: str, keys: list[tuple[str, str, str]]) -> str:
    def row(position: int, key: str, kind: str, value: str) -> str:
        values = ", ".join(
            f"CAST({value if field == kind else 'NULL'} AS {_VALUE_TYPES[field]}) AS {name}"
            for field, name in _VALUE_NAMES.items()
        )
        return (
            f"SELECT query_id, node_id, CAST({position} AS INTEGER) AS position, "
            f"'{key}' AS key, {values} FROM {source}"
        )

    return " UNION ALL ".join(row(i, *k) for i, k in enumerate(keys))


def _sent() -> str:
    """The attributes of both kinds of spans as export documents carry them."""
    scope = "service AS service_name, 'spanloom' AS scope_name, '0.1.0' AS scope_version, span_id"
    kinds = [("query_span", _QUERY_KEYS), ("plan_span", _PLAN_KEYS)]
    rows = " UNION ALL ".join(_exploded(*k).replace("query_id, node_id", scope) for k in kinds)
    return _with([source for source, _ in kinds], f"SELECT * FROM ({rows}) t")


def _with(needs: list[str], select: str, deep: bool = False) -> str:
    """``select`` preceded by what it needs, in order of definition."""
    texts = _PARTS | _DEEP_PARTS if deep else _PARTS
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for need in texts[name][0]:
                add(need)

    for need in needs:
        add(need)
    parts = ", ".join(f"{n} AS ({texts[n][1]})" for n in texts if n in wanted)
    return f"WITH RECURSIVE {parts} {select}"


_QUERY_SPAN_COLUMNS = """query_id, trace_id, span_id, parent_span_id, name, start_unix_nano,
  end_unix_nano, duration_us, db_operation, db_statement, startup_seconds, total_seconds,
  service AS service_name"""
_PLAN_SPAN_COLUMNS = """query_id, node_id, trace_id, span_id, parent_span_id, name, start_unix_nano,
  end_unix_nano, emit_order, duration_us, node_type, plan_tables, startup_cost, total_cost,
  plan_rows, width_bytes, parallel_aware, parallel_safe, async_capable, startup_seconds,
  total_seconds, rows, secondary_rows, loops, filtered_scan_join, filtered_other,
  service AS service_name"""
_NESTED = """SELECT query_id, count(*) AS nodes, CAST(sum(n.total_ns) AS BIGINT) AS node_ns,
  CAST(max(n.node_id) AS INTEGER) AS last_node
FROM executions JOIN plan_nodes n USING (query_id) GROUP BY query_id"""
_SUBTREE_ROWS = """SELECT query_id, node_id, CAST(row_number() OVER
  (PARTITION BY query_id, node_id ORDER BY first_at) AS INTEGER) AS ordinal, table_name FROM firsts"""
_QUERY_ROWS = "SELECT DISTINCT query_id, table_name FROM walk WHERE table_name IS NOT NULL"
_NUMBERED = f"""SELECT *, CAST((row_number() OVER (PARTITION BY service_name, bucket
    ORDER BY query_id, emit_order) - 1) // {BATCH_SPANS} AS INTEGER) AS batch
  FROM (SELECT *, CAST((CAST('0x' || substr(md5(CAST(query_id AS VARCHAR)), 1, 8) AS BIGINT)
    + (emit_order - 1) // {BATCH_SPANS}) % {BATCH_BUCKETS} AS INTEGER) AS bucket FROM spans) t"""


def statements() -> dict[str, str]:
    spans = _with(["spans"], "SELECT * FROM spans")
    deep_spans = _with(["spans"], "SELECT * FROM spans", deep=True)
    return {
        "slow_executions": _with(
            ["slow"], "SELECT query_id, total_ns, min_duration_ms FROM slow"
        ),
        "slow_query_times": _with(
            ["slow"],
            """SELECT query_id, label, finished_unix_nano - total_ns AS wall_start_nano,
              finished_unix_nano - total_ns + start_offset_ns AS start_unix_nano,
              finished_unix_nano + start_offset_ns AS end_unix_nano,
              start_offset_ns / 1e9 AS startup_seconds, total_ns / 1e9 AS total_seconds FROM slow""",
        ),
        "operation_labels": _with(
            ["executions"],
            """SELECT operation, CASE WHEN operation IN ('CMD_SELECT', 'CMD_UPDATE', 'CMD_INSERT',
                'CMD_DELETE', 'CMD_MERGE', 'CMD_UTILITY', 'CMD_NOTHING')
                THEN substr(operation, 5) ELSE 'UNKNOWN' END AS label, count(*) AS executions
              FROM executions GROUP BY operation""",
        ),
        "comment_traceparent": _with(
            ["commented"],
            "SELECT query_id, found AS traceparent FROM executions LEFT JOIN commented USING (query_id)",
        ),
        "landed_executions": _with(
            ["executions"],
            """SELECT *, CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason
            FROM executions WHERE query_id % 97 <> 0 AND query_id % 89 <> 0
            UNION ALL BY NAME
            SELECT '{"query_id": ' || query_id || ', "total_ns": ' AS line, 'unreadable' AS reason
            FROM executions WHERE query_id % 97 = 0
            UNION ALL BY NAME
            SELECT '{"total_ns": ' || total_ns || '}' AS line, 'no id' AS reason
            FROM executions WHERE query_id % 97 <> 0 AND query_id % 89 = 0""",
        ),
        "trace_context": _with(["context"], "SELECT * FROM context"),
        "relation_names": _with(["named"], "SELECT query_id, node_id, table_name FROM named"),
        "nested_plans": _with(["executions", "plan_nodes"], _NESTED),
        "nested_plans_deep": _with(["executions", "plan_nodes"], _NESTED, deep=True),
        "subtree_tables": _with(
            ["subtrees"], "SELECT query_id, node_id, side_path, tables, visible FROM subtrees"
        ),
        "subtree_table_rows": _with(["firsts"], _SUBTREE_ROWS),
        "subtree_table_rows_deep": _with(["firsts"], _SUBTREE_ROWS, deep=True),
        "query_table_rows": _with(["walk"], _QUERY_ROWS),
        "query_table_rows_deep": _with(["walk"], _QUERY_ROWS, deep=True),
        "query_tables": _with(["roots"], "SELECT query_id, tables FROM roots"),
        "plan_visibility": _with(["walk"], "SELECT query_id, node_id, visible FROM walk"),
        "bounded_text": f"""SELECT doc_id, {_bounded("t", 512)} AS bounded,
            CAST(strlen({_bounded("t", 512)}) AS INTEGER) AS bytes
            FROM (SELECT doc_id, trim(text, '{_BLANK}') AS t FROM documents) d""",
        "query_spans": _with(["query_span"], f"SELECT {_QUERY_SPAN_COLUMNS} FROM query_span"),
        "plan_span_names": _with(["plan_span"], "SELECT query_id, node_id, name FROM plan_span"),
        "plan_span_times": _with(
            ["plan_span"],
            """SELECT query_id, node_id, start_unix_nano, end_unix_nano, startup_seconds,
              total_seconds FROM plan_span""",
        ),
        "plan_tables_capped": _with(["capped"], "SELECT query_id, node_id, plan_tables FROM capped"),
        "plan_parents": _with(
            ["plan_span"], "SELECT query_id, node_id, span_id, parent_span_id FROM plan_span"
        ),
        "plan_spans": _with(["plan_span"], f"SELECT {_PLAN_SPAN_COLUMNS} FROM plan_span"),
        "emit_order": _with(["spans"], "SELECT query_id, node_id, level, emit_order FROM spans"),
        "spans": spans,
        "spans_by_operators": spans,
        "spans_deep": deep_spans,
        "spans_from_nested_deep": deep_spans,
        "query_tables_deep": _with(["roots"], "SELECT query_id, tables FROM roots", deep=True),
        "plan_tables_capped_deep": _with(
            ["capped"], "SELECT query_id, node_id, plan_tables FROM capped", deep=True
        ),
        "spans_from_nested": spans,
        "spans_split_trees": spans,
        "subtree_tables_joined": _with(
            ["subtrees"], "SELECT query_id, node_id, side_path, tables, visible FROM subtrees"
        ),
        "stream_spans": spans,
        "stream_compacted": spans,
        "otlp_files": _sent(),
        "stream_otlp": _sent(),
        "span_files": spans,
        "query_attributes": _with(["query_span"], _exploded("query_span", _QUERY_KEYS)),
        "plan_attributes": _with(["plan_span"], _exploded("plan_span", _PLAN_KEYS)),
        "span_resources": _with(
            ["spans"],
            """SELECT service_name, 'postgresql' AS framework_name, '19' AS framework_version,
              count(*) AS spans FROM spans GROUP BY service_name""",
        ),
        "otlp_batches": _with(
            ["spans"],
            f"""SELECT service_name, bucket, batch, count(*) AS span_count,
              min(span_id) AS min_span_id, max(span_id) AS max_span_id
            FROM ({_NUMBERED}) t GROUP BY service_name, bucket, batch""",
        ),
        "otlp_documents": _with(
            ["spans"],
            f"""SELECT service_name, trace_id, span_id,
              CASE WHEN parent_span_id = '{ZERO_SPAN}' THEN '' ELSE parent_span_id END
                AS parent_span_id, name,
              CAST(CASE WHEN level = 'query' THEN 2 ELSE 1 END AS INTEGER) AS kind,
              CAST(CASE WHEN level = 'query' THEN 769 ELSE 257 END AS INTEGER) AS flags,
              CAST(start_unix_nano AS VARCHAR) AS start_unix_nano,
              CAST(end_unix_nano AS VARCHAR) AS end_unix_nano,
              CAST(CASE WHEN level = 'query' THEN 8 ELSE 20 END AS INTEGER) AS attribute_count,
              CASE WHEN level = 'plan' THEN CAST(width_bytes AS VARCHAR) END AS width_bytes
            FROM spans""",
        ),
    }
