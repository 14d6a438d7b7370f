"""Byte-bounded text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the mark that ends a shortened text (three bytes in UTF-8).
ELLIPSIS = "…"


def _whole_characters(text: Column, limit: int) -> Column:
    """The whole characters in the first ``limit`` bytes of a longer ``text``.

    The first ``limit + 1`` bytes begin exactly one character more than that.
    """
    begun = F.length(F.substring(text.cast("binary"), 1, limit + 1).cast("string"))
    return text.substr(F.lit(1), begun - 1)


def cut_bytes(text: Column, limit: int) -> Column:
    """The longest whole-character prefix of ``text`` within ``limit`` bytes."""
    return F.when(F.octet_length(text) <= limit, text).otherwise(_whole_characters(text, limit))


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE_SPACE))


def bounded(trimmed_text: Column, limit: int) -> Column:
    """Trimmed text shortened to ``limit`` bytes, the ellipsis included."""
    kept = limit - len(ELLIPSIS.encode())
    return F.when(F.octet_length(trimmed_text) <= limit, trimmed_text).otherwise(
        F.concat(_whole_characters(trimmed_text, kept), F.lit(ELLIPSIS))
    )


def with_bounded_text(df: DataFrame, name: str, text: Column, limit: int) -> DataFrame:
    """Add ``name``: ``text`` without surrounding white space, bounded. The trim runs once."""
    return (
        df.withColumn("_trimmed", trimmed(text))
        .withColumn(name, bounded(F.col("_trimmed"), limit))
        .drop("_trimmed")
    )
