"""Small hand-made inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spanloom.schemas import EXECUTIONS, NAMESPACES, PLAN_NODES, RELATIONS

TRACEPARENT = "00-4bf92f3577b34da6a3ce929d0e0e4736-00f067aa0ba902b7-01"


def _rows(schema: T.StructType, defaults: dict, rows: list[dict]) -> list[tuple]:
    return [tuple({**defaults, **row}.get(name) for name in schema.fieldNames()) for row in rows]


def executions(spark: SparkSession, *rows: dict) -> DataFrame:
    defaults = {
        "query_id": 1,
        "finished_unix_nano": 10_000_000_000,
        "total_ns": 2_000_000_000,
        "start_offset_ns": 500,
        "operation": "CMD_SELECT",
        "source_text": "SELECT 1",
        "min_duration_ms": 0,
    }
    return spark.createDataFrame(_rows(EXECUTIONS, defaults, list(rows)), EXECUTIONS)


def plan_nodes(spark: SparkSession, *rows: dict, table_name: bool = False) -> DataFrame:
    """With ``table_name`` the nodes come with resolved names instead of relation oids."""
    defaults = {
        "query_id": 1,
        "plan_type": "T_SeqScan",
        "state_type": "T_SeqScanState",
        "instrumented": True,
        "startup_cost": 0.5,
        "total_cost": 1.5,
        "plan_rows": 10.0,
        "width_bytes": 8,
        "parallel_aware": False,
        "parallel_safe": True,
        "async_capable": False,
        "start_offset_ns": 100,
        "startup_ns": 200,
        "total_ns": 300,
        "rows": 1.0,
        "secondary_rows": 2.0,
        "loops": 3.0,
        "filtered_scan_join": 4.0,
        "filtered_other": 5.0,
    }
    schema = PLAN_NODES
    if table_name:
        schema = T.StructType([*PLAN_NODES.fields, T.StructField("table_name", T.StringType())])
    return spark.createDataFrame(_rows(schema, defaults, list(rows)), schema)


def catalog(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    relations = spark.createDataFrame([(10, "a", 1), (11, "b", 1), (12, "c", 9)], RELATIONS)
    namespaces = spark.createDataFrame([(1, "public")], NAMESPACES)
    return relations, namespaces
