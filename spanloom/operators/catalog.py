"""Resolve the relation read by each plan node to a table name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.config import SpanConfig
from spanloom.operators.joins import checked_join

# The plan types that scan a relation.
SCAN_TYPES = [
    "T_SeqScan",
    "T_SampleScan",
    "T_IndexScan",
    "T_IndexOnlyScan",
    "T_BitmapIndexScan",
    "T_BitmapHeapScan",
    "T_TidScan",
    "T_TidRangeScan",
    "T_SubqueryScan",
    "T_FunctionScan",
    "T_ValuesScan",
    "T_TableFuncScan",
    "T_CteScan",
    "T_NamedTuplestoreScan",
    "T_WorkTableScan",
    "T_ForeignScan",
    "T_CustomScan",
]


def table_names(relations: DataFrame, namespaces: DataFrame) -> DataFrame:
    """``relation_oid`` → ``namespace.relation``, or the bare name where the namespace is unknown."""
    known = relations.filter(F.col("relation_oid").isNotNull() & F.col("relation_name").isNotNull())
    return known.join(namespaces, "namespace_oid", "left").select(
        "relation_oid",
        F.concat_ws(".", "namespace_name", "relation_name").alias("table_name"),
    )


def resolve_relations(
    plan_nodes: DataFrame,
    relations: DataFrame,
    namespaces: DataFrame,
    config: SpanConfig = SpanConfig(),
) -> DataFrame:
    """Add ``table_name``: null for non-scans, scans without a relation and unknown relations."""
    scanned = F.when(F.col("plan_type").isin(SCAN_TYPES), F.col("relation_oid"))
    nodes = plan_nodes.withColumn("_scanned_oid", scanned)
    catalog = table_names(relations, namespaces).withColumnRenamed("relation_oid", "_scanned_oid")
    return checked_join(
        nodes,
        catalog,
        on=["_scanned_oid"],
        spread=["query_id", "node_id"],
        how="left",
        max_broadcast_bytes=config.max_broadcast_bytes,
        salts=config.join_salts,
    ).drop("_scanned_oid")
