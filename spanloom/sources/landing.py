"""Captures that land as JSON lines, of which some are damaged."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.schemas import EXECUTIONS, NESTED_EXECUTIONS, PLAN_NODES

_CORRUPT = "_corrupt_record"

UNREADABLE, WITHOUT_ID = "unreadable", "no id"


class Landed(NamedTuple):
    """Rows of the declared schema, and the lines that give none as ``(file, line, reason)``."""

    rows: DataFrame
    damaged: DataFrame


def _read(
    spark: SparkSession, path: str, schema: T.StructType, streaming: bool, options: dict[str, str]
) -> Landed:
    reader = spark.readStream if streaming else spark.read
    lines = reader.options(**options).text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"))
    # Lines are parsed whole whatever columns are read: a line is damaged or not for every reader.
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(
        "value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    blank = F.trim("value") == ""
    lines = lines.filter(~blank).withColumn("row", parsed)
    unreadable = F.col("row").isNull() | F.col(f"row.{_CORRUPT}").isNotNull()
    reason = F.when(unreadable, UNREADABLE).when(F.col("row.query_id").isNull(), WITHOUT_ID)
    judged = lines.withColumn("reason", reason)
    rows = judged.filter("reason is null").select(*(f"row.{n}" for n in schema.fieldNames()))
    damaged = judged.filter("reason is not null").select(
        "file", F.col("value").alias("line"), "reason"
    )
    return Landed(rows, damaged)


def read_landed_executions(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    nested: bool | None = None,
    **options: str,
) -> Landed:
    """Finished executions from JSON lines. Lines that are no JSON, or have a value of another type, or
    no ``query_id``, are kept apart; unknown fields are ignored and missing ones are null. A stream
    carries its plans in the ``plan`` column, see ``nested``."""
    with_plan = streaming if nested is None else nested
    schema = NESTED_EXECUTIONS if with_plan else EXECUTIONS
    return _read(spark, path, schema, streaming, options)


def read_landed_plan_nodes(spark: SparkSession, path: str, **options: str) -> Landed:
    """Plan nodes from JSON lines, as :func:`read_landed_executions`."""
    return _read(spark, path, PLAN_NODES, False, options)


def damage_report(damaged: DataFrame) -> DataFrame:
    """Per file and reason the number of damaged lines."""
    return damaged.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("lines"))
