"""Joins of a large side, possibly with hot keys, against a side of unknown size."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators.lineage import cut_lineage

# Keys that are looked for as hot ones, in the sketch and in the broadcast of what it finds.
MAX_HOT_KEYS = 1000
# Allowance per row for fixed-width values and row headers.
_ROW_OVERHEAD_BYTES = 64


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of ``df``: one aggregate pass, one row to the driver."""
    texts = [F.octet_length(F.col(c)) for c, t in df.dtypes if t == "string"]
    width = F.lit(_ROW_OVERHEAD_BYTES + 8 * len(df.columns)).cast("bigint")
    for text in texts:
        width = width + F.coalesce(text, F.lit(0))
    return df.agg(F.sum(width).alias("bytes")).first()["bytes"] or 0


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """``wanted`` names, lengthened until none of them is taken."""
    used = {name.lower() for name in taken}
    names = []
    for name in wanted:
        while name in used:
            name += "_"
        used.add(name)
        names.append(name)
    return names


def hot_keys(large: DataFrame, on: list[str], partitions: int, salts: int) -> DataFrame:
    """``(_hash, _salts)`` of the keys with more rows than a task's share: how many tasks each needs,
    at most ``salts``.

    One pass with a sketch of frequent items. A key above the share is among the tracked ones, and at
    most as many keys as there are ``partitions`` can be, so the result is small by construction.
    """
    known = reduce(and_, (F.col(c).isNotNull() for c in on))
    hashed = large.filter(known).select(F.xxhash64(*on).alias("_hash"))
    # Frequent items may be missed only below total / tracked; allow for a margin of eight.
    top, tracked = min(partitions, MAX_HOT_KEYS), max(1000, 8 * min(partitions, MAX_HOT_KEYS))
    found = hashed.agg(
        F.call_function("approx_top_k", F.col("_hash"), F.lit(top), F.lit(tracked)).alias("_top"),
        F.count(F.lit(1)).alias("_total"),
    )
    share = F.greatest(F.col("_total") / partitions, F.lit(1))
    needed = F.ceil(F.col("_item.count") / share).cast("bigint")
    return (
        found.select("_total", F.explode("_top").alias("_item"))
        .filter(F.col("_item.count") > share)
        .select(F.col("_item.item").alias("_hash"), F.least(needed, F.lit(salts)).alias("_salts"))
    )


def checked_join(
    large: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread: list[str],
    how: str,
    max_broadcast_bytes: int,
    salts: int,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join on ``on``: broadcast ``lookup`` when its measured size allows, else by a shuffle in which
    hot keys are salted.

    A key that has more rows than a task's share is spread over as many tasks as it fills, at most
    ``salts``, by the columns ``spread``; only its rows of ``lookup`` are repeated. Rows with a null key
    go to any task. Both ways give the same rows. Hot keys are looked for in ``counted`` where given: a
    table with the columns ``on`` that is cheaper to read than ``large`` and has about its keys.
    """
    if measured_bytes(lookup) <= max_broadcast_bytes:
        return large.join(F.broadcast(lookup), on, how)
    partitions = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = cut_lineage(hot_keys(large if counted is None else counted, on, partitions, salts))
    if how in ("inner", "left_semi") and hot.isEmpty():
        return large.join(lookup, on, how)  # rows that come by key already are not dealt again
    hashed, ways, salt = free_names([*large.columns, *lookup.columns], "_hash", "_salts", "_salt")
    hot = hot.withColumnsRenamed({"_hash": hashed, "_salts": ways})

    def marked(df: DataFrame) -> DataFrame:
        keyed = df.withColumn(hashed, F.xxhash64(*on))
        return keyed.join(F.broadcast(hot), hashed, "left").drop(hashed)

    spread_hash = F.xxhash64(*spread)
    no_key = reduce(or_, (F.col(c).isNull() for c in on))  # meets nothing, so it may go anywhere
    times = F.coalesce(F.col(ways), F.lit(1))
    own_salt = F.when(no_key, spread_hash).otherwise(F.pmod(spread_hash, times))
    every_salt = F.explode(F.sequence(F.lit(0).cast("bigint"), times - 1))
    salted = marked(large).withColumn(salt, own_salt).drop(ways)
    repeated = marked(lookup).withColumn(salt, every_salt).drop(ways)
    return salted.join(repeated, [*on, salt], how).drop(salt)
