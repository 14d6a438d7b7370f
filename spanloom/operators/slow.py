"""Keep the executions that reach their slow-query threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NANOS_PER_MS = 1_000_000


def slow_executions(executions: DataFrame, default_min_duration_ms: int = -1) -> DataFrame:
    """Rows whose ``total_ns`` reaches ``min_duration_ms``, or the default where that is null.

    A threshold of 0 keeps every timed execution, a negative one keeps none.
    """
    own, total = F.col("min_duration_ms"), F.col("total_ns")
    has_own = own >= 0

    # Weaker conditions on bare columns, which reach the Parquet scan.
    if default_min_duration_ms >= 0:
        default_ns = default_min_duration_ms * NANOS_PER_MS
        scannable = has_own | (own.isNull() & (total >= F.lit(default_ns).cast("bigint")))
    else:
        scannable = has_own

    threshold = F.coalesce(own, F.lit(default_min_duration_ms))
    reached = (threshold >= 0) & (total >= threshold.cast("bigint") * NANOS_PER_MS)
    return executions.filter(total.isNotNull() & scannable).filter(reached)
