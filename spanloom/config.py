"""Settings of the span jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SpanConfig:
    # Slow-execution threshold for rows without one of their own: 0 keeps all, negative keeps none.
    default_min_duration_ms: int = -1

    # Prefix of the comment token that carries the caller's trace context.
    marker: str = "traceparent="

    # Trace id of an execution without a valid context: "zero" or "derive" (hash of the query id).
    orphan_trace: str = "zero"

    # "true" gives microseconds; "reference" keeps the two inconsistent units of the original.
    duration_us: str = "true"

    service_name: str = "postgresql"
    framework_name: str = "postgresql"
    framework_version: str = "19"
    scope_name: str = "spanloom"
    scope_version: str = "0.1.0"

    # Trees above this many nodes are never gathered into one row; they take the joined route.
    max_tree_nodes: int = 1024

    # A side is broadcast only after its measured size is found to be within this bound.
    max_broadcast_bytes: int = 64 * 1024 * 1024

    # Ways a hot join key is split when the other side is too large to broadcast.
    join_salts: int = 32

    # Upper bound of spans in one export document.
    max_batch_spans: int = 512

    def __post_init__(self) -> None:
        if self.orphan_trace not in ("zero", "derive"):
            raise ValueError("orphan_trace must be 'zero' or 'derive'")
        if self.duration_us not in ("true", "reference"):
            raise ValueError("duration_us must be 'true' or 'reference'")
        if not self.marker:
            raise ValueError("marker must not be empty")
