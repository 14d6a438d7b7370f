"""Trace context carried in SQL comments and W3C ``traceparent`` values, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanloom.functions.ids import ZERO_SPAN_ID, ZERO_TRACE_ID

# Version 00 has exactly four fields, later versions may append more, ff is reserved.
TRACEPARENT = (
    r"^(?:00-[0-9a-f]{32}-[0-9a-f]{16}-[0-9a-f]{2}"
    r"|(?!00|ff)[0-9a-f]{2}-[0-9a-f]{32}-[0-9a-f]{16}-[0-9a-f]{2}(?:-(?s:.*))?)\z"
)

_SPACE = r" \t\n\f\r"


def comment_traceparent(text: Column, marker: str) -> Column:
    """The first marked value inside a (possibly nested) block comment, else null.

    The whole text is read left to right as comment openers, closers and marked words. A marked word
    starts a comment or follows white space, and ends at white space or at the closer.
    """
    characters = ["\\" + c if re.match(r"[^\w\s]", c, re.ASCII) else c for c in marker]
    quoted, quoted_first = "".join(characters), characters[0]
    pieces = F.regexp_extract_all(
        text,
        F.lit(
            # The lookahead skips most characters without trying the alternatives.
            rf"(?=[/*{quoted_first}])"
            rf"(?:/\*|\*/|(?:(?<=/\*)|(?<=[{_SPACE}])){quoted}(?:(?!\*/)[^{_SPACE}])*+)"
        ),
        F.lit(0),
    )

    def step(state: Column, piece: Column) -> Column:
        opener, closer = piece == "/*", piece == "*/"
        depth = (
            F.when(opener, state["depth"] + 1)
            .when(closer, F.greatest(state["depth"] - 1, F.lit(0)))
            .otherwise(state["depth"])
        )
        here = F.when(
            ~opener & ~closer & (state["depth"] > 0), F.substring(piece, len(marker) + 1, 2**31 - 1)
        )
        return F.struct(depth.alias("depth"), F.coalesce(state["found"], here).alias("found"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("found"))
    folded = F.aggregate(pieces, start, step)["found"]
    # Most statements carry no marker; a plain substring test spares them the pattern.
    return F.when(F.contains(text, F.lit(marker)), folded)


def is_valid_traceparent(value: Column) -> Column:
    return F.coalesce(
        value.rlike(TRACEPARENT)
        & (F.substring(value, 4, 32) != ZERO_TRACE_ID)
        & (F.substring(value, 37, 16) != ZERO_SPAN_ID),
        F.lit(False),
    )


def trace_id_of(value: Column) -> Column:
    return F.substring(value, 4, 32)


def parent_id_of(value: Column) -> Column:
    return F.substring(value, 37, 16)
