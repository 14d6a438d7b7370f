"""Capture tables derived from the given star-schema tables.

The statements follow FIXTURES.md. They run in Spark and, with another ``{micros}``, in the SQL
engine that checks the results.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.operators.lineage import cut_lineage

MARKER = "mark.traceparent="
DEFAULT_MIN_DURATION_MS = 100

SPARK_MICROS = "unix_micros(CAST(o_orderdate AS TIMESTAMP))"
CHECK_MICROS = "epoch_us(o_orderdate)"

EXECUTIONS_SQL = """
SELECT o_orderkey AS query_id,
  {micros} * 1000 AS finished_unix_nano,
  CAST(round(o_totalprice * 1000) AS BIGINT) AS total_ns,
  (o_orderkey % 1000) * 1000 AS start_offset_ns,
  CASE CAST(o_orderkey % 9 AS INT) WHEN 0 THEN 'CMD_SELECT' WHEN 1 THEN 'CMD_UPDATE' WHEN 2 THEN 'CMD_INSERT'
    WHEN 3 THEN 'CMD_DELETE' WHEN 4 THEN 'CMD_MERGE' WHEN 5 THEN 'CMD_UTILITY' WHEN 6 THEN 'CMD_NOTHING'
    WHEN 7 THEN 'CMD_OTHER' ELSE 'CMD_SELECT' END AS operation,
  CASE CAST(o_orderkey % 7 AS INT)
    WHEN 0 THEN concat('SELECT * /* mark.traceparent=', tp, ' */ FROM t')
    WHEN 1 THEN concat('/*mark.traceparent=', tp, '*/ SELECT 1')
    WHEN 2 THEN concat('SELECT 1 /* a /* b */ mark.traceparent=', tp, ' */')
    WHEN 3 THEN concat('SELECT 1 /* a */ , mark.traceparent=', tp)
    WHEN 4 THEN concat('SELECT ''x'' /* a */ /* k=1 mark.traceparent=', tp, ' mark.traceparent=second */')
    WHEN 5 THEN '/* mark.traceparent=00-00000000000000000000000000000000-0000000000000000-01 */ SELECT 2'
    ELSE concat('  SELECT 3 -- ', repeat('é', CAST(o_orderkey % 400 AS INT))) END AS source_text,
  CASE CAST(o_orderkey % 11 AS INT) WHEN 0 THEN concat('00-', md5(concat('u', CAST(o_orderkey AS VARCHAR(20)))), '-00f067aa0ba902b7-00')
    WHEN 1 THEN 'garbage' ELSE NULL END AS traceparent_setting,
  CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 250 WHEN 1 THEN -1 WHEN 2 THEN 0 ELSE NULL END AS min_duration_ms,
  CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN 'billing' ELSE NULL END AS service_name
FROM (SELECT *, concat('00-', md5(concat('t', CAST(o_orderkey AS VARCHAR(20)))), '-',
        substr(md5(concat('s', CAST(o_orderkey AS VARCHAR(20)))), 1, 16), '-01') AS tp FROM {orders}) o
"""

_NODE_ORDER = """l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
      l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, l_orderkey"""
_ORDERED = [name.strip() for name in _NODE_ORDER.split(",")]
_NODE_NUMBER = f"row_number() OVER (PARTITION BY query_id ORDER BY {_NODE_ORDER})"

_NODES_SQL = """
SELECT query_id, node_id,
  CASE WHEN node_id = 1 THEN NULL ELSE CAST(floor(node_id / 2) AS INT) END AS parent_node_id,
  CASE WHEN node_id = 1 THEN NULL WHEN node_id % 2 = 0 THEN 'L' ELSE 'R' END AS side,
  plan_type, concat(plan_type, 'State') AS state_type,
  CASE WHEN plan_type = 'T_FunctionScan' THEN NULL WHEN l_partkey % 20 = 0 THEN {relation} + 1000000 ELSE {relation} END AS relation_oid,
  NOT (l_returnflag = 'R' AND l_quantity > 45) AS instrumented,
  l_tax * 10 AS startup_cost, l_extendedprice AS total_cost, l_quantity * 10 AS plan_rows,
  CAST(8 * l_linenumber AS INT) AS width_bytes,
  l_linenumber % 2 = 0 AS parallel_aware, l_linenumber % 3 > 0 AS parallel_safe, l_returnflag = 'A' AS async_capable,
  (l_partkey % 100) * 10 AS start_offset_ns, l_partkey * 100 AS startup_ns,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS total_ns,
  l_quantity AS rows, l_discount * 100 AS secondary_rows, CAST(l_linenumber AS DOUBLE) AS loops,
  l_quantity * 2 AS filtered_scan_join, l_quantity * 3 AS filtered_other
FROM (SELECT *,
    CASE CAST(l_linenumber AS INT) WHEN 1 THEN 'T_HashJoin' WHEN 2 THEN 'T_SeqScan' WHEN 3 THEN 'T_IndexScan' WHEN 4 THEN 'T_Sort'
      WHEN 5 THEN 'T_BitmapHeapScan' WHEN 6 THEN 'T_FunctionScan' ELSE 'T_SeqScan' END AS plan_type,
    CAST({number} AS INT) AS node_id
  FROM (SELECT *, {query_id} AS query_id FROM {lineitem}) l) n
"""

PLAN_NODES_SQL = (
    _NODES_SQL.replace("{number}", _NODE_NUMBER)
    .replace("{query_id}", "l_orderkey")
    .replace("{relation}", "l_suppkey")
)

# Five queries share a fourth of all nodes, so their trees grow with the input; the others have some
# 20 nodes each. Trees have more tables than a span lists, and a seventh of the names are too long.
_DEEP_QUERY_ID = "CASE WHEN l_orderkey % 4 = 0 THEN l_suppkey % 5 + 1 ELSE l_partkey + 100 END"
_DEEP_NODES_SQL = _NODES_SQL.replace("{relation}", "(l_orderkey % 50 + 1)")
DEEP_PLAN_NODES_SQL = _DEEP_NODES_SQL.replace("{number}", _NODE_NUMBER).replace(
    "{query_id}", _DEEP_QUERY_ID
)

# Bits of a monotonically increasing id that count the rows of a partition.
_PART_SHIFT = 33

# Nodes of a query that one task sorts to number them; those of larger ones are numbered by ranges.
SORTED_NODES = 100_000

DEEP_RELATIONS_SQL = (
    "SELECT s_suppkey AS relation_oid, CASE WHEN s_suppkey % 7 = 0 "
    "THEN concat(s_name, repeat('é', 30)) ELSE s_name END AS relation_name, "
    "s_nationkey AS namespace_oid FROM {supplier}"
)

RELATIONS_SQL = (
    "SELECT s_suppkey AS relation_oid, s_name AS relation_name, "
    "CASE WHEN s_nationkey < 5 THEN s_nationkey + 1000 ELSE s_nationkey END AS namespace_oid "
    "FROM {supplier}"
)

NAMESPACES_SQL = "SELECT n_nationkey AS namespace_oid, n_name AS namespace_name FROM {nation}"


def _numbered_by_ranges(keyed: DataFrame) -> DataFrame:
    """Add ``_number``, the place of a row among those of its ``_query`` in the order of nodes.

    All tasks sort a range each; a row's place is that in its range and the rows of the ranges before.
    """
    ranged = keyed.select("_query", *_ORDERED).repartitionByRange("_query", *_ORDERED)
    ranged = ranged.sortWithinPartitions("_query", *_ORDERED)
    placed = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", _PART_SHIFT))
    # One row per query and range, of which there are no more than ranges and queries together.
    parts = placed.groupBy(F.col("_query").alias("_of"), F.col("_part").alias("_in")).agg(
        F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    offsets = F.broadcast(parts.select("_of", "_in", "_from", before.alias("_before")))
    own = F.col("_query").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in"))
    number = F.col("_at") - F.col("_from") + 1 + F.col("_before")
    return placed.join(offsets, own).select("_query", *_ORDERED, number.alias("_number"))


class Capture:
    """The four capture tables over one directory of the given Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        # The derivation reads zone-less order dates as UTC instants.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self._dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")

    @property
    def executions(self) -> DataFrame:
        return self.spark.sql(
            EXECUTIONS_SQL.replace("{micros}", SPARK_MICROS), orders=self.table("orders")
        )

    @property
    def plan_nodes(self) -> DataFrame:
        return self.spark.sql(PLAN_NODES_SQL, lineitem=self.table("lineitem"))

    @property
    def relations(self) -> DataFrame:
        return self.spark.sql(RELATIONS_SQL, supplier=self.table("supplier"))

    @property
    def namespaces(self) -> DataFrame:
        return self.spark.sql(NAMESPACES_SQL, nation=self.table("nation"))


class DeepCapture(Capture):
    """The same executions with fewer and larger plan trees over other tables."""

    @cached_property
    def plan_nodes(self) -> DataFrame:
        lineitem = self.table("lineitem")
        keyed = lineitem.withColumn("_query", F.expr(_DEEP_QUERY_ID))
        counts = keyed.groupBy("_query").agg(F.count(F.lit(1)).alias("_n"))
        hot = cut_lineage(counts.filter(F.col("_n") > SORTED_NODES).select("_query"))
        if hot.isEmpty():
            return self.spark.sql(DEEP_PLAN_NODES_SQL, lineitem=lineitem)
        # A query above the bound has that share of the rows, so these are few.
        hot = F.broadcast(hot.withColumnRenamed("_query", "_hot"))
        is_hot = F.col("_query").eqNullSafe(F.col("_hot"))
        # Sorted once, as large inputs read their nodes more than once.
        number = F.row_number().over(Window.partitionBy("_query").orderBy(*_ORDERED))
        usual = keyed.join(hot, is_hot, "left_anti")
        usual = cut_lineage(usual.select("_query", *_ORDERED, number.cast("bigint").alias("_number")))
        ranged = _numbered_by_ranges(keyed.join(hot, is_hot, "left_semi"))
        numbered = _DEEP_NODES_SQL.replace("{number}", "_number").replace("{query_id}", "_query")
        return self.spark.sql(numbered, lineitem=usual.unionByName(ranged))

    @property
    def relations(self) -> DataFrame:
        return self.spark.sql(DEEP_RELATIONS_SQL, supplier=self.table("supplier"))
