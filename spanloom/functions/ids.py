"""Identifiers derived from keys, so that a recomputed task gives the same ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_TRACE_ID = "0" * 32
ZERO_SPAN_ID = "0" * 16


def query_span_id(query_id: Column) -> Column:
    return _hashed(query_id, F.lit("q"))


def node_span_id(query_id: Column, node_id: Column) -> Column:
    return _hashed(query_id, node_id.cast("string"))


def _hashed(query_id: Column, part: Column) -> Column:
    return F.substring(F.md5(F.concat(query_id.cast("string"), F.lit("|"), part)), 1, 16)


def derived_trace_id(query_id: Column) -> Column:
    return F.md5(query_id.cast("string"))
