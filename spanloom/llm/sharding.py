"""A reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of their keys. A Feistel network permutes the smallest domain
of an even number of bits that holds all numbers; a number that lands outside is sent through the
network again (cycle walking) until it lands inside, which makes the network a permutation of exactly
the numbers at hand. The permuted number ``p`` of a row gives its shard ``p % shards`` and its slot
``p // shards``, so shards differ by at most one row, slots have no gaps, and the place of a row, or
the row of a place, follows from ``(number, count, seed)`` alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.operators.lineage import cut_lineage

SHARDS, SEED, ROUNDS = 24, 17, 6
LAW = "rows"  # counts of shards are at most one apart

# Shifts and factors of the public 32-bit Murmur3 finaliser.
MIX_SHIFTS = (16, 13, 16)
MIX_FACTORS = (0x85EBCA6B, 0xC2B2AE35)
_LOW32 = 0xFFFFFFFF

# Helper columns.
_PART, _NUMBER, _TIE, _OFFSET, _HASH = "__part", "__number", "__tie", "__offset", "__text_hash"


def round_keys(seed: int) -> list[int]:
    """A 32-bit key per round."""
    digest = hashlib.sha256(str(seed).encode()).digest()
    return [int.from_bytes(digest[4 * r : 4 * r + 4], "big") for r in range(ROUNDS)]


def half_bits(count: int) -> int:
    """Bits of half a number in the smallest domain of an even number of bits for ``count`` rows."""
    return max(1, (max(count - 1, 1).bit_length() + 1) // 2)


def _mix(half: np.ndarray, key: int) -> np.ndarray:
    value = (half + np.uint64(key)) & np.uint64(_LOW32)
    for shift, factor in zip(MIX_SHIFTS, (*MIX_FACTORS, None)):
        value ^= value >> np.uint64(shift)
        if factor is not None:
            value = (value * np.uint64(factor)) & np.uint64(_LOW32)
    return value


def _network(numbers: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = numbers >> np.uint64(bits), numbers & mask
    for key in keys:
        left, right = right, left ^ (_mix(right, key) & mask)
    return (left << np.uint64(bits)) | right


def _network_back(numbers: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = numbers >> np.uint64(bits), numbers & mask
    for key in reversed(keys):
        left, right = right ^ (_mix(left, key) & mask), left
    return (left << np.uint64(bits)) | right


def _walk(numbers, count: int, seed: int, step) -> np.ndarray:
    """``step`` on every number until it is below ``count``: fewer than four steps on average."""
    bits, keys = half_bits(count), round_keys(seed)
    found = step(np.array(numbers, np.uint64), bits, keys)
    while len(outside := np.flatnonzero(found >= count)):
        found[outside] = step(found[outside], bits, keys)
    return found


def permute(numbers, count: int, seed: int = SEED) -> np.ndarray:
    """The permuted row numbers; ``numbers`` are below ``count``."""
    return _walk(numbers, count, seed, _network)


def unpermute(numbers, count: int, seed: int = SEED) -> np.ndarray:
    """The row numbers that ``permute`` sends to ``numbers``."""
    return _walk(numbers, count, seed, _network_back)


def row_number_at(shard: int, slot: int, shards: int, count: int, seed: int = SEED) -> int:
    """The number of the row in a place."""
    return int(unpermute([slot * shards + shard], count, seed)[0])


def _number_within(batches):
    """Add the task's number and the rows' numbers within the task."""
    part, first = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        own = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(first, first + n))]
        first += n
        names = [*batch.schema.names, _PART, _NUMBER]
        yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=names)


def number_rows(rows: DataFrame, keys: list[Column]) -> tuple[DataFrame, int]:
    """``rows`` with ``__number`` from 0 in the order of ``keys``, and their count.

    Keys are range-partitioned and numbered within their task; only counts per task meet. Rows with
    equal keys are spread by a running number, so that no key is bound to one task: which of them
    comes first is fixed once, in a written table.
    """
    tied = cut_lineage(rows.withColumn(_TIE, F.monotonically_increasing_id()))
    order = [*keys, F.col(_TIE)]
    ranged = tied.repartitionByRange(*order).sortWithinPartitions(*order).drop(_TIE)
    schema = T.StructType(
        [*ranged.schema.fields]
        + [T.StructField(_PART, T.IntegerType()), T.StructField(_NUMBER, T.LongType())]
    )
    numbered = cut_lineage(ranged.mapInArrow(_number_within, schema))
    counts = numbered.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_OFFSET), "n"
    )
    offsets = cut_lineage(offsets)  # a row per task
    count = offsets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    placed = numbered.join(F.broadcast(offsets.drop("n")), _PART)
    total = (F.col(_NUMBER) + F.col(_OFFSET)).alias(_NUMBER)
    return placed.select(*rows.columns, total), count


def place_rows(
    rows: DataFrame, keys: list[Column], shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` behind their columns, shuffled by ``seed``.

    Counts of shards are at most one apart and slots of a shard run from 0 without gaps. Null keys
    come first. Equal rows get a place each. The result depends on the rows, ``shards`` and ``seed``
    only, not on files or tasks; among rows with equal keys places may be exchanged. An empty table
    gives an empty result. The columns of ``rows`` may have any names but ``shard`` and ``slot``.
    """
    numbered, count = number_rows(rows, keys)
    schema = T.StructType(
        [*rows.schema.fields]
        + [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    )

    def place(batches):
        for batch in batches:
            at = permute(batch[_NUMBER].to_numpy(), count, seed)
            shard = pa.array((at % np.uint64(shards)).astype(np.int32))
            slot = pa.array((at // np.uint64(shards)).astype(np.int64))
            columns = [*batch.columns[:-1], shard, slot]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return numbered.mapInArrow(place, schema)


def document_keys() -> list[Column]:
    """The order of documents before the shuffle: by id, then by a hash of the text."""
    return [F.col("doc_id"), F.col(_HASH)]


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: its size, the CRC-32 of its text and its place under the law ``rows``.

    Size is the bytes of the text plus 8; a null text has none and counts as empty. Texts of any
    length are only measured and hashed, and never shuffled. Null and repeated ids are allowed; rows
    that share id and text may exchange places. Equal texts are spread like others. Only ``doc_id``
    and ``text`` are read, so other columns may have any name; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias(_HASH),
    )
    return place_rows(narrow, document_keys(), shards, seed).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Whole documents as Parquet folders ``shard=<n>``, each file in the order of ``slot``.

    A shard is cut into ranges of slots, so that a shard is not bound to one task.
    """
    hashed = docs.withColumn(_HASH, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    placed = place_rows(hashed, document_keys(), shards, seed).drop(_HASH)
    dealt = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
