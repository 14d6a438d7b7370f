"""Link executions to their caller's trace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions import ids, traceparent


def attach_trace_context(
    executions: DataFrame, marker: str = "traceparent=", orphan_trace: str = "zero"
) -> DataFrame:
    """Add ``trace_id``, ``parent_span_id`` and ``has_context``.

    A session setting wins over a comment even when it is malformed. Without a valid value both ids
    are zero; ``orphan_trace="derive"`` gives such rows a trace id hashed from the query id.
    """
    if orphan_trace not in ("zero", "derive"):
        raise ValueError("orphan_trace must be 'zero' or 'derive'")
    found = F.coalesce(
        F.col("traceparent_setting"), traceparent.comment_traceparent(F.col("source_text"), marker)
    )
    no_trace = (
        F.lit(ids.ZERO_TRACE_ID)
        if orphan_trace == "zero"
        else ids.derived_trace_id(F.col("query_id"))
    )
    value, valid = F.col("_traceparent"), F.col("has_context")
    return (
        executions.withColumn("_traceparent", found)
        .withColumn("has_context", traceparent.is_valid_traceparent(value))
        .withColumn("trace_id", F.when(valid, traceparent.trace_id_of(value)).otherwise(no_trace))
        .withColumn(
            "parent_span_id",
            F.when(valid, traceparent.parent_id_of(value)).otherwise(F.lit(ids.ZERO_SPAN_ID)),
        )
        .drop("_traceparent")
    )
